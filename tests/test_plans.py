import datetime as dt

from cardspark import schemas
from cardspark.operators.clean import IdentityRules
from cardspark.plans import card_status, identity_run, transactions
from conftest import values
from test_files import put, status_line

D, T = dt.date, dt.datetime


def test_files_to_families(spark, tmp_path, house):
    names = [f.name for f in schemas.RAW_TRANSACTIONS.fields if f.name not in ("CardType", "FileSource", "TransactionTime")]

    def line(day, tp, side="Debit"):
        cells = {"TransactionTP": tp, "DebitCredit": side, "TransactionResult": "APPROVED", "CardHolderID": "1", "Amount": "-2",
                 "DistributorCode": "7", "Fee": "1", "Rate": "1", "RemainingBalance": "5", "Surcharge": "0"}
        return ",".join([f"2024-01-{day}", "10:00:00", "Ann", *[cells.get(n, "t") for n in names]])

    header = ",".join(["Date", "Time", "FirstName", *names])
    put(tmp_path / "in", "BLACKRECON_010224_1.csv", header, line(31, "POS Domestic"), line(31, "Monthly Fee"))
    put(tmp_path / "in", "BLACKRECON_310124_1.csv", header, line(30, "ATM Domestic"), line(30, "Voucher load", "Credit"), line(30, "Bank Payment"))
    transactions.ingest_transactions(house, str(tmp_path / "in"), D(2024, 1, 30), D(2024, 1, 31))
    assert house.table("raw_transactions").count() == 5
    for _ in range(2):
        for day in (D(2024, 1, 30), D(2024, 1, 31)):
            transactions.add_day(house, day)
    counts = {n: house.table(n).count() for n in ("pos", "atm", "other", "fees", "loads")}
    assert counts == {"pos": 1, "atm": 1, "other": 1, "fees": 1, "loads": 1}
    days = values(house.table("atm"), "TransactionTime", "Amount", "year", "month")
    transactions.build_families(house)
    assert values(house.table("atm"), "TransactionTime", "Amount", "year", "month") == days == [(T(2024, 1, 30, 10), 2.0, 2024, 1)]


def test_daily_snapshot_then_identity(spark, tmp_path, house):
    def card(ident, mail, phone, birth):
        cells = status_line("C", ident).split(",")
        cells[2], cells[22], cells[10] = mail, phone, birth
        return ",".join(cells)

    put(tmp_path / "in", "cards-2024-01-05.csv", card("1", "a@x", "11", "Jan  5 1980 12:00AM"), card("2", "b@x", "22", "Jan  6 1980 12:00AM"))
    put(tmp_path / "in", "cards-2024-01-06.csv", card("1", "a@x", "11", "Jan  5 1980 12:00AM"), card("2", "a@x", "22", "Jan  6 1980 12:00AM"),
        card("3", "c@x", "33", "Jan  7 1980 12:00AM"))
    folder = str(tmp_path / "in")
    rules = IdentityRules(bad_birth_dates=[])
    card_status.daily_card_status(house, folder, D(2024, 1, 5))
    first = identity_run.first_build(house, rules)
    assert values(first, "CardHolderID", "USER_ID", "PERSON_ID") == [("1", 1, "1"), ("2", 2, "2")]
    cards = card_status.daily_card_status(house, folder, D(2024, 1, 6))
    assert cards.count() == 3
    assert values(house.table("customer_changes"), "CardHolderID", "Is_ch_Email", "total_ch", "dt_change") == [("2", 1, 1, T(2024, 1, 5))]
    assert house.table("status_changes").count() == 0
    assert values(house.table("address_changes"), "CardHolderID") == [("3",)]
    after = identity_run.daily_run(house, T(2024, 1, 6, 8), rules)
    assert values(after, "CardHolderID", "USER_ID") == [("1", 1), ("2", 1), ("3", 3)]
    assert values(house.table("user_changes"), "CardHolderID", "USER_ID") == [("2", 2)]
    assert house.table("phones").count() == 3 and house.table("persons").count() == 3

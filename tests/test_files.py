import datetime as dt
import gzip

import pytest

from cardspark.operators.clean import clean_activations, clean_card_status, clean_change_snapshot, clean_transactions
from cardspark.sinks import files, profile, tables
from cardspark.sources import landing
from conftest import values

D = dt.date


def put(folder, name, *lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(line + "\n" for line in lines), encoding="ISO-8859-1")


def test_transaction_window_tests_the_day_of_the_rows(spark, tmp_path):
    for name in ["X_020124_1.csv", "X_030124_1.csv", "X_040124_1.csv", "note_1.csv", "X_0301_1.csv", "skip.txt"]:
        put(tmp_path / "in", name, "a", "1")
    folder = str(tmp_path / "in")
    got = landing.landing_files(spark, folder, "transactions", D(2024, 1, 2), D(2024, 1, 2))
    assert values(got, "file_name", "file_day", "data_day", "Year", "Month", "Day") == [
        ("X_030124_1.csv", D(2024, 1, 3), D(2024, 1, 2), 2024, 1, 2)]
    assert landing.landing_files(spark, folder, "transactions", D(2024, 1, 2)).count() == 2
    rows = landing.read_landing(spark, folder, "transactions", D(2024, 1, 2), D(2024, 1, 3))
    assert values(rows, "FileSource", "a") == [("X_030124_1.csv", "1"), ("X_040124_1.csv", "1")]


def test_activation_and_status_windows_test_the_file_day(spark, tmp_path):
    put(tmp_path / "in", "report_x_20240105_a.csv", "a", "1")
    put(tmp_path / "in", "report_20240105123.csv", "a", "1")
    put(tmp_path / "in", "cards-2024-01-05.csv", "a", "1")
    folder = str(tmp_path / "in")
    got = landing.landing_files(spark, folder, "activations", D(2024, 1, 5), D(2024, 1, 5))
    assert values(got, "file_name") == [("report_20240105123.csv",)]
    put(tmp_path / "in2", "report_20240105120000.csv", "a", "1")
    put(tmp_path / "in2", "report_20240105.csv", "a", "1")
    got = landing.landing_files(spark, str(tmp_path / "in2"), "activations", D(2024, 1, 5), D(2024, 1, 5))
    assert values(got, "file_name") == [("report_20240105.csv",), ("report_20240105120000.csv",)]
    got = landing.landing_files(spark, folder, "status", D(2024, 1, 5))
    assert values(got, "file_name") == [("cards-2024-01-05.csv",)]


HEAD = ["7", "n", "e@x", "Ann", "Doe", "Paris", "FR", "active", "203", "app", "Jan  5 1980 12:00AM", "s", "FR1",
        "Jan  1 2019  1:00AM", "Jan  2 2019  1:00PM", "ADDRESS", "", "75001", "2.0", "2109"]


def status_line(layout, ident):
    tail = {"A20": [], "A21": ["10.5"], "B": ["10.5", "u", "00336", "udf", "v"], "C": ["10.5", "u", "00336", "classic", "v"]}
    return ",".join([ident, *HEAD[1:], *tail[layout]])


def test_status_layout_follows_the_file_date(spark, tmp_path):
    days = {"2019-01-14": "A20", "2019-01-15": "A21", "2019-01-16": "B", "2019-03-12": "B", "2019-03-13": "C"}
    for i, (day, layout) in enumerate(days.items()):
        put(tmp_path / "in", f"cards-{day}.csv", status_line(layout, str(i)))
    raw = landing.read_card_status(spark, str(tmp_path / "in"))
    got = values(clean_card_status(raw), "CardHolderID", "AvailableBalance", "NoMobile", "Programme", "KYC_Status",
                 "IsRenewal", "IsExcludedAddress", "BirthDate", "ExpirationDate")
    born, end = dt.datetime(1980, 1, 5), dt.datetime(2021, 9, 1)
    assert got == [
        ("0", None, None, None, "KYC", 1, 1, born, end), ("1", 10.5, None, None, "KYC", 1, 1, born, end),
        ("2", 10.5, "336", None, "KYC", 1, 1, born, end), ("3", 10.5, "336", None, "KYC", 1, 1, born, end),
        ("4", 10.5, "336", "classic", "KYC", 1, 1, born, end)]
    assert values(raw, "file_day") == [(D.fromisoformat(d),) for d in days]
    assert clean_change_snapshot(raw).columns[:3] == ["CardHolderID", "Email", "FirstName"]
    only = landing.read_card_status(spark, str(tmp_path / "in"), D(2019, 3, 12), D(2019, 3, 13))
    assert values(only, "CardHolderID") == [("3",), ("4",)]


def test_layout_a_takes_20_or_21_cells_only(spark, tmp_path):
    lines = [status_line("A20", "1"), status_line("A21", "2"), "3,only", status_line("B", "4") + ",x,y,z"]
    put(tmp_path / "in", "cards-2019-01-14.csv", *lines)
    with pytest.raises(Exception, match="(?i)malformed"):
        landing.read_card_status(spark, str(tmp_path / "in")).collect()
    rows = landing.read_card_status(spark, str(tmp_path / "in"), mode="DROPMALFORMED")
    assert values(rows, "CardHolderID", "AvailableBalance") == [("1", None), ("2", "10.5")]
    assert rows.count() == 2


def test_columns_go_by_the_header_of_each_file(spark, tmp_path):
    from cardspark.schemas import all_text
    put(tmp_path / "in", "A_030124_1.csv", "Date,Time,Amount,Fee", "2024-01-02,10:00:00,1,5")
    put(tmp_path / "in", "B_030124_1.csv", "Date,Time,Fee,Amount,More", "2024-01-02,10:00:00,6,2,x")
    put(tmp_path / "in", "C_050124_1.csv", "Fee,Date", "7,2024-01-04")
    rows = landing.read_landing(spark, str(tmp_path / "in"), "transactions", D(2024, 1, 2), D(2024, 1, 2))
    assert values(rows, "Amount", "Fee", "More") == [("1", "5", None), ("2", "6", "x")]
    schema = all_text(["Fee", "Amount"])
    rows = landing.read_landing(spark, str(tmp_path / "in"), "transactions", D(2024, 1, 2), D(2024, 1, 2), schema)
    assert rows.columns == ["Amount", "Fee", "FileSource"] and values(rows, "Amount", "Fee") == [("1", "5"), ("2", "6")]
    with pytest.raises(ValueError, match="lacks"):
        landing.read_landing(spark, str(tmp_path / "in"), "transactions", schema=schema)
    none = landing.read_landing(spark, str(tmp_path / "in"), "transactions", D(2025, 1, 1), schema=schema)
    assert none.columns == ["Fee", "Amount", "FileSource"] and none.count() == 0


def test_a_day_without_a_file_keeps_the_cards(house, tmp_path):
    from cardspark.plans.card_status import CARDS, daily_card_status
    put(tmp_path / "in", "cards-2019-04-01.csv", status_line("C", "1"))
    daily_card_status(house, str(tmp_path / "in"), D(2019, 4, 1))
    with pytest.raises(ValueError, match="no card-status rows"):
        daily_card_status(house, str(tmp_path / "in"), D(2019, 4, 2))
    assert house.table(CARDS).count() == 1


def test_times_do_not_depend_on_the_session_zone(spark):
    from cardspark.functions.text import long_date
    from cardspark.operators.clean import clean_activations
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Paris")
    try:
        rows = spark.createDataFrame([("31/03/2024 02:30:00", "1", "f")], "ActivationTime string, CardholderID string, FileSource string")
        assert values(clean_activations(rows), "ActivationTime") == [(dt.datetime(2024, 3, 31, 2, 30),)]
        texts = ["Mar 31 2024  2:30AM", "Jan  5 1980 12:00AM", "dec 5 1980 12:15PM", "Jan 5 1980", "Xyz 1 2020 1:00AM", "Feb 30 2020 1:00AM", None]
        got = spark.createDataFrame([(t,) for t in texts], "t string").select(long_date("t").alias("v")).collect()
        assert [r.v for r in got] == [dt.datetime(2024, 3, 31, 2, 30), dt.datetime(1980, 1, 5), dt.datetime(1980, 12, 5, 12, 15), None, None, None, None]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_a_bad_line_fails_or_is_dropped(spark, tmp_path):
    put(tmp_path / "in", "a.csv", "x,y", "1,2", "1,2,3")
    from cardspark.schemas import all_text
    schema = all_text(["x", "y"])
    with pytest.raises(Exception, match="(?i)malformed"):
        landing.read_csv(spark, str(tmp_path / "in"), schema).collect()
    assert landing.read_csv(spark, str(tmp_path / "in"), schema, mode="DROPMALFORMED").collect() == [("1", "2")]


def test_clean_transactions(spark, tmp_path):
    from cardspark import schemas
    names = [f.name for f in schemas.RAW_TRANSACTIONS.fields if f.name not in ("CardType", "FileSource", "TransactionTime")]
    header = ",".join(["Date", "Time", "First Name", *names])

    def line(date, time, amount):
        cells = {"Amount": amount, "CardHolderID": "'12'", "DistributorCode": "7", "Fee": "0", "Rate": "1",
                 "RemainingBalance": "5", "Surcharge": "0"}
        return ",".join([date, time, "Ann", *[cells.get(n, "t") for n in names]])

    put(tmp_path / "in", "BLACKRECON_030124_1.csv", header, line("2024-01-02", "10:00:00", "-3.5"), line("2024-01-01", "10:00:00", "1"),
        line("2024-01-02", "late", "2"))
    put(tmp_path / "in", "OTHER_030124_1.csv", header, line("2024-01-02", "11:00:00", "9"))
    put(tmp_path / "in", "BLACKRECON_x_030124_1.csv", header, line("2024-01-02", "11:00:00", "9"))
    rows = landing.read_landing(spark, str(tmp_path / "in"), "transactions")
    out = clean_transactions(rows)
    assert out.schema.fieldNames() == schemas.RAW_TRANSACTIONS.fieldNames() and len(out.columns) == 33
    assert values(out, "CardHolderID", "Amount", "CardType", "TransactionTime", "FileSource") == [
        ("12", 2.0, "BLACK", None, "BLACKRECON_030124_1.csv"),
        ("12", 3.5, "BLACK", dt.datetime(2024, 1, 2, 10), "BLACKRECON_030124_1.csv"),
        ("12", 9.0, "OTHER_030124_1.csv", dt.datetime(2024, 1, 2, 11), "OTHER_030124_1.csv")]


def test_a_bad_activation_date_fails(spark):
    ok = spark.createDataFrame([("'1'", "05/01/2024 10:00:00", "f")], "CardholderID string, ActivationTime string, FileSource string")
    assert values(clean_activations(ok), "CardHolderID", "ActivationTime") == [("1", dt.datetime(2024, 1, 5, 10))]
    with pytest.raises(Exception):
        clean_activations(spark.createDataFrame([("1", "2024-01-05", "f")], ok.schema)).collect()


def test_ingest_counts_lines_and_applies_the_hook(spark, tmp_path, house):
    put(tmp_path / "in", "a.csv", "x", "1", "2")
    put(tmp_path / "in", "b.csv", "x", "3")

    def hook(df, by):
        return df.selectExpr(f"CAST(x AS INT) * {by} AS x", "FileSource")

    for mode, n in [("append", 3), ("append", 6), ("overwrite", 3)]:
        counts = files.ingest_files(spark, str(tmp_path / "in"), house.name("t"), hook, {"by": 10}, mode, house.path("t"))
        assert values(counts, "file_name", "lines") == [("a.csv", 2), ("b.csv", 1)]
        assert house.table("t").count() == n
    assert values(house.table("t"), "x", "FileSource") == [(10, "a.csv"), (20, "a.csv"), (30, "b.csv")]


def test_each_file_replaces_only_its_own_table(spark, tmp_path):
    put(tmp_path / "in", "a.csv", "x", "1")
    put(tmp_path / "in2", "b.csv", "x", "2")
    root = str(tmp_path / "out")
    for folder in ["in", "in2", "in"]:
        files.ingest_file_per_table(spark, str(tmp_path / folder), root)
    assert values(spark.read.parquet(root), "x", "file_stem") == [("1", "a"), ("2", "b")]


def test_export_names_delimiter_and_compression(spark, tmp_path):
    df = spark.createDataFrame([(1, "a;b")], "n int, t string")
    folder = files.export_csv(df, str(tmp_path / "out"), D(2024, 2, 1), compression="gzip")
    assert folder.endswith("out_20240201")
    # one part per partition, in no certain order; those without rows have the header alone
    parts = {gzip.open(p, "rt").read() for p in (tmp_path / "out_20240201").glob("*.csv.gz")}
    assert parts - {"n;t\n"} == {'n;t\n1;"a;b"\n'}


def test_append_is_idempotent_by_day(spark, house):
    rows = spark.createDataFrame([(1, dt.datetime(2024, 1, 31, 23)), (2, dt.datetime(2024, 2, 1, 0))], "id int, TransactionTime timestamp_ntz")
    for _ in range(2):
        for day in ["2024-01-31", "2024-02-01"]:
            tables.append_day_to_table(rows, house.name("t"), day, house.path("t"))
    assert values(house.table("t"), "id", "year", "month") == [(1, 2024, 1), (2, 2024, 2)]
    more = rows.unionByName(spark.createDataFrame([(3, dt.datetime(2024, 2, 2))], rows.schema))
    assert values(tables.append_day(house.table("t"), more), "id") == [(3,)]
    plan = tables.period(house.table("t"), tables.one_day("2024-01-31"))._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(" in plan


def test_refresh_reads_what_it_replaces(spark, house):
    house.replace("s", spark.createDataFrame([(1,), (2,)], "id int"))
    house.replace("s", house.table("s").selectExpr("id * 10 AS id"))
    house.replace("s", house.table("s").filter("id > 10"))
    assert values(house.table("s"), "id") == [(20,)]


def test_declared_tables_and_profiles(spark, house):
    from cardspark import schemas
    made = tables.create_table(spark, house.name("acts"), schemas.ACTIVATIONS, path=house.path("acts"))
    assert made.columns == ["ActivationTime", "CardHolderID", "FileSource"]
    assert tables.schema_like(spark, house.name("acts")) == schemas.ACTIVATIONS
    df = spark.createDataFrame([("a" * 20, "b" * 21, 1, 1.0, dt.datetime(2024, 1, 1), None)],
                               "s string, l string, n int, d double, t timestamp_ntz, e string")
    types = profile.infer_column_types(df, {"n": "BIGINT"})
    assert [tuple(r) for r in types.collect()] == [
        ("s", "VARCHAR (40)"), ("l", "TEXT"), ("n", "BIGINT"), ("d", "double precision"),
        ("t", "timestamp without time zone"), ("e", "VARCHAR (40)")]
    assert profile.jdbc_column_types(types).startswith("`s` VARCHAR (40), `l` TEXT")
    assert profile.table_profile(df).collect() == [(1, 6)]


def test_read_table_by_name_or_query(spark, house):
    house.replace("s", spark.createDataFrame([(1,), (2,)], "id int"))
    assert landing.read_table(spark, house.name("s")).count() == 2
    assert landing.read_table(spark, f"SELECT id FROM {house.name('s')} WHERE id > 1").count() == 1


def test_snapshot_follows_added_removed_and_retyped_columns(spark, tmp_path):
    import uuid

    from cardspark.sinks import tables

    name = "snap_" + uuid.uuid4().hex
    root = str(tmp_path / "snap")
    tables.refresh_snapshot(spark.createDataFrame([(1, "a")], "id long, c1 string"), name, root)
    tables.refresh_snapshot(spark.createDataFrame([(2, "b")], "id long, c2 string"), name, root)
    assert spark.table(name).columns == ["id", "c2"] and [tuple(r) for r in spark.table(name).collect()] == [(2, "b")]
    tables.refresh_snapshot(spark.createDataFrame([(3, 4)], "id string, c2 int"), name, root)
    assert str(spark.table(name).schema.simpleString()) == "struct<id:string,c2:int>"
    tables.refresh_snapshot(spark.createDataFrame([("5", 6)], "id string, c2 int"), name, root)
    assert [tuple(r) for r in spark.table(name).collect()] == [("5", 6)]

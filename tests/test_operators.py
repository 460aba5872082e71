import datetime as dt

import pytest
from pyspark.sql import functions as F

from cardspark.functions.dates import Period
from cardspark.operators import age, categorize as cat, changes, clusters, families as fam, kpis, merchants, monthly, usage
from cardspark.sinks.tables import with_month
from cardspark.sources import rules as rule_tables
from conftest import values

T = dt.datetime
JAN = Period.months("2024_1", "2024_1")
AS_OF = T(2024, 2, 15)
RAW = ("CardHolderID string, TransactionTime timestamp_ntz, Amount double, TransactionTP string, DebitCredit string, "
       "TransactionResult string, Fee double, Surcharge double, RemainingBalance double, MCC string, MerchantName string")


def raw(spark, *rows):
    out = []
    for r in rows:
        base = dict(card="1", time=T(2024, 1, 10), amount=1.0, tp="POS Domestic", side="Debit", result="APPROVED", fee=0.0,
                    surcharge=0.0, balance=0.0, mcc="A", shop="shop") | r
        out.append(tuple(base.values()))
    df = spark.createDataFrame(out, RAW)
    return df.withColumns({c: F.lit("x") for c in
                           ["Currency", "CardVPUType", "MerchantAddress", "MerchantCity", "MerchantCountry", "MerchantID", "TransactionID"]})


def test_families_split(spark):
    df = raw(spark, {"tp": "POS International"}, {"tp": "ATM Domestic"}, {"tp": "FX Fee", "surcharge": -2.0},
             {"tp": "Monthly Fee", "surcharge": -2.0}, {"tp": "Voucher load", "side": "Credit"}, {"tp": "Fee Reversal"},
             {"tp": "Bank Payment", "result": "DECLINED"}, {"tp": "Some Auth"}, {"tp": None}, {"tp": "POS Domestic", "side": "Credit"})
    assert values(fam.pos(df), "TransactionTP", "IsPOSInternational") == [("POS International", 1)]
    assert values(fam.atm(df), "TransactionTP", "IsInternational") == [("ATM Domestic", 0)]
    assert values(fam.fees(df), "TransactionTP", "Surcharge") == [("FX Fee", 2.0), ("Monthly Fee", -2.0)]
    assert values(fam.loads(df), "TransactionTP") == [("Voucher load",)]
    assert values(fam.other(df), "TransactionTP", "IsReversal", "IsFee") == [("Bank Payment", 0, 0), ("Fee Reversal", 1, 1)]


def test_bulk_is_the_union_of_days(spark):
    df = with_month(raw(spark, *[{"time": T(2024, 1, 30) + dt.timedelta(hours=8 * i), "amount": float(i)} for i in range(12)]))
    days = [fam.pos(df, dt.date(2024, 1, 30) + dt.timedelta(days=i)) for i in range(5)]
    union = days[0]
    for d in days[1:]:
        union = union.unionByName(d)
    assert values(union, "Amount") == values(fam.pos(df), "Amount")
    assert days[1].count() == 3


def tables(df):
    return {"pos": fam.pos(df), "atm": fam.atm(df), "other": fam.other(df), "load": fam.loads(df), "fees": fam.fees(df)}


def test_card_kpis_zeroes_ties_and_windows(spark):
    df = raw(
        spark,
        {"amount": 10.0, "time": T(2024, 1, 31, 23)}, {"amount": 5.0, "time": T(2023, 12, 31), "tp": "POS International"},
        {"amount": 7.0, "time": T(2024, 1, 31, 23), "tp": "ATM Domestic"}, {"amount": 3.0, "tp": "Bank Payment"},
        {"card": "2", "amount": -4.0}, {"card": "3", "tp": "Monthly Fee", "fee": 1.5, "surcharge": 0.5},
    )
    cards = spark.createDataFrame([("1",), ("2",), ("3",), ("4",)], "CardHolderID string")
    types = spark.createDataFrame([("POS Domestic", "POS", 1), ("POS International", "POS", 0)],
                                  "TransactionTP string, group_transactions string, IsVolontaire int")
    out = {r["CardHolderID"]: r for r in kpis.card_kpis(tables(df), cards, types, JAN, AS_OF).collect()}
    assert list(out["1"].asDict()) == sorted(out["1"].asDict()) and len(out["1"]) == 88
    one = out["1"]
    assert (one["sum_amount_pos"], one["frequency_pos"], one["num_month_pos"]) == (10.0, 1, 1)
    assert (one["spendings_3_months"], one["spendings_12_months"]) == (25.0, 25.0)
    assert (one["pos_part"], one["atm_part"], one["other_part"]) == (0.5, 0.35, 0.15)
    assert (one["Nb_Transaction_POS_3_M"], one["Nb_Transaction_Volontaire_3_M"]) == (2, 1)
    assert (one["derniere_action"], one["derniere_action_nom"]) == (T(2024, 1, 31, 23), "dernier_retrait")
    assert one["recence_pos"] == 14
    for card in "24":
        r = out[card]
        assert r["derniere_action"] is None and r["derniere_action_nom"] == "" and r["dernier_achat"] is None
        assert r["recence_pos"] == 0 and r["atm_part"] == 0.0 and r["international_pos_part"] == 0.0
    assert (out["3"]["card_ca"], out["3"]["derniere_action_nom"]) == (2.0, "dernier_fees")


def test_months_are_counted_beyond_one_mask_word(spark):
    long = Period.months("2010_1", "2020_12")
    df = raw(spark, *[{"time": T(2010 + y, m, 5), "amount": 2.0} for y in range(11) for m in (1, 1, 12)])
    got = kpis.family_monthly_kpis(fam.pos(df), "pos", long)
    assert values(got, "num_month_pos", "monthly_avg_amount_pos", "monthly_average_frequency_pos") == [(22, 3.0, 1.5)]


def test_window_counts_outside_the_period(spark):
    df = raw(spark, {"time": T(2024, 3, 9), "amount": 4.0}, {"time": T(2023, 10, 30, 23), "amount": 2.0}, {"time": T(2023, 10, 31), "amount": 1.0})
    got = kpis.spend_last_months(fam.pos(df), fam.other(df), fam.atm(df), JAN)
    assert values(got, "spendings_3_months", "spendings_6_months") == [(5.0, 7.0)]


def test_monthly_habits(spark):
    df = raw(
        spark,
        {"time": T(2024, 1, 2, 6), "side": "Credit", "amount": 30.0}, {"time": T(2024, 1, 10, 13), "side": "Credit", "amount": 10.0},
        {"time": T(2024, 1, 6, 3), "amount": 4.0}, {"time": T(2024, 1, 25, 21), "amount": 12.0, "balance": 7.0},
        {"time": T(2024, 1, 25, 21), "amount": 0.0, "fee": 1.0, "balance": 8.0}, {"time": T(2024, 2, 1), "amount": 5.0, "balance": 1.0},
        {"card": "0"},
    )
    jan = df.filter(F.month("TransactionTime") == 1)
    r = monthly.monthly_kpis(jan).collect()
    assert len(r) == 1
    r = r[0]
    assert (r["part_credit_begin"], r["part_debit_end"], r["remaining_balance_end_month"]) == (0.75, 0.75, 7.5)
    assert r["part_debit_credit"] == pytest.approx(16 / 56)
    assert (r["frequence_debit_jour_moment_nuit"], r["frequence_debit_is_week_end_week_end"]) == (1, 1)
    roll = monthly.rollup_months(df)
    x = roll.first()
    assert (x["num_events"], x["remaining_balance_end_month"], x["part_debit_end"]) == (2, 8.5, 0.75)
    n = monthly.normalize_rollup(roll).first()
    shares = [n[c] for c in monthly.COUNT_COLUMNS]
    assert sum(shares) == pytest.approx(3.0) and n["sum_frequency_mois_moment"] == 3
    assert n["avg_remaining_balance_end_month"] == 4.25


def test_latest_rows_keep_ties(spark):
    df = spark.createDataFrame([("a", 1, 1), ("a", 2, 2), ("a", 2, 3), ("b", 1, 4)], "k string, t int, id int")
    assert values(monthly.latest_rows(df, "k", "t"), "id") == [(2,), (3,), (4,)]


def test_align_fills_gaps(spark):
    a = spark.createDataFrame([("1", 1)], "CardHolderID string, x int")
    b = spark.createDataFrame([("1", 2, 5), ("2", 3, 6)], "CardHolderID string, x int, y int")
    assert values(monthly.align(a, b), "CardHolderID", "x", "y") == [("1", 3, 5), ("2", 3, 6)]


def test_usage(spark):
    df = raw(spark, {"amount": 3.0, "mcc": "B"}, {"amount": 3.0, "mcc": "A"}, {"amount": 0.0, "mcc": "C"}, {"mcc": ""},
             {"card": "2", "mcc": None})
    matrix = usage.usage(fam.pos(df), "MCC", "amount_paid", JAN)
    assert values(matrix, "CardHolderID", "A", "B") == [("1", 3.0, 3.0)]
    got = usage.usage_summary(matrix, "MCC")
    assert values(got, "A_Prop", "B_Prop", "max_usage_MCC", "MCC_most_used", "num_MCC") == [(0.5, 0.5, 0.5, "A", 2)]
    assert usage.usage(fam.pos(df), "MCC", "frequency", JAN, ["A", "Z"]).columns == ["CardHolderID", "A", "Z"]
    with pytest.raises(ValueError):
        usage.usage(fam.pos(df), "MCC", "median", JAN)


def test_weighted_age(spark):
    df = raw(spark, {"time": T(2020, 1, 1), "amount": 30.0}, {"time": T(2022, 1, 1), "amount": 10.0, "tp": "ATM Domestic"},
             {"card": "2"}, {"card": "3"}, {"card": "4", "amount": 0.0}, {"card": "5"})
    cards = spark.createDataFrame(
        [("1", T(1990, 6, 1), "KYC"), ("2", T(1988, 8, 8), "KYC"), ("3", T(1990, 1, 1), "SDD"), ("4", T(1990, 1, 1), "KYC"), ("5", None, "KYC")],
        "CardHolderID string, BirthDate timestamp_ntz, KYC_Status string")
    got = age.weighted_age(fam.pos(df), fam.atm(df), fam.other(df), cards)
    assert values(got, "CardHolderID", "age_pondere") == [("1", 30.5)]


def rule_set(spark, override=(), fill=(), mcc=(("shops", "S", "U", "c1", 1),)):
    return rule_tables.prepare_rules(
        spark.createDataFrame([("UA", "SA", "U", "S"), ("UB", "SB", "V", "W")],
                              "UNIVERS_DATABASE string, SOUS_UNIVERS_DATABASE string, UNIVERS string, SOUS_UNIVERS string"),
        spark.createDataFrame([("c1", "A"), ("c2", "B")], "MCC_CODE string, MCC string"),
        spark.createDataFrame(list(mcc), "MCC_NAME string, SOUS_UNIVERS string, UNIVERS string, MCC_CODE string, NOTE int"),
        spark.createDataFrame(list(override), "MCC string, UNIVERS string, SOUS_UNIVERS string, NEW_REGEX string, rule_order int"),
        spark.createDataFrame(list(fill), "UNIVERS string, SOUS_UNIVERS string, NEW_REGEX string, rule_order int"),
    )


def test_last_override_and_first_fill_win(spark):
    rules = rule_set(spark, [("shops", "V", "W", "shop", 2), ("shops", "U", "S", "SHOP", 1)], [("V", "W", "x", 1), ("U", "S", "x|y", 2), (None, None, "(", 3)])
    pos = fam.pos(raw(spark, {"shop": "my shop"}, {"mcc": "B", "shop": "XY"}, {"mcc": "B", "shop": "y"}, {"mcc": None, "shop": None}, {"shop": None}))
    got = cat.categorize(pos, rules)
    assert values(got, "MCC", "MerchantName", "UNIVERS", "SOUS_UNIVERS") == [
        ("A", "my shop", "UB", "SB"), ("A", None, "UA", "SA"), ("B", "XY", "UB", "SB"), ("B", "y", "UA", "SA"), (None, None, "", "")]
    assert got.columns == pos.columns


def test_a_code_pass_overrides_an_earlier_regex_and_rows_keep_old_labels(spark):
    mcc = [("shops", "S", "U", "c1", 1), ("shops", "S", "U", "c1", 0)]
    rules = rule_set(spark, [("shops", "V", "W", "shop", 1)], mcc=[mcc[0]])
    pos = fam.pos(raw(spark, {"mcc": "Z", "shop": "shop"})).withColumns({"UNIVERS": F.lit("old"), "SOUS_UNIVERS": F.lit("one")})
    for step in (cat.categorize_mcc, cat.categorize_override, cat.categorize_fill, cat.categorize):
        assert values(step(pos, rules), "UNIVERS", "SOUS_UNIVERS") == [("old", "one")]
    assert values(cat.categorize_mcc(fam.pos(raw(spark, {})), rules), "UNIVERS") == [("UA",)]


def test_fill_rules_in_several_passes(spark, monkeypatch):
    monkeypatch.setattr(cat, "RULES_PER_PASS", 2)
    fill = [("V", "W", f"a{i}$", i) for i in range(5)] + [("U", "S", "a", 9)]
    pos = fam.pos(raw(spark, {"mcc": "B", "shop": "a4"}, {"mcc": "B", "shop": "a9"}, {"mcc": "B", "shop": "b"}))
    assert values(cat.categorize_fill(pos, rule_set(spark, fill=fill)), "MerchantName", "UNIVERS") == [("a4", "UB"), ("a9", "UA"), ("b", "")]


def test_a_bad_pattern_fails_on_load(spark):
    with pytest.raises(Exception, match="(?i)pattern"):
        rule_set(spark, fill=[("U", "S", "a(", 1)])


def test_rules_from_folders(spark, tmp_path):
    made = rule_set(spark, [("shops", "V", "W", "shop", 1)], [("U", "S", "x", 1)])
    for name in ["categories", "mcc_link", "mcc_categories", "override", "fill"]:
        getattr(made, name).coalesce(1).write.option("header", True).csv(f"{tmp_path}/csv/{name}")
        getattr(made, name).write.parquet(f"{tmp_path}/parquet/{name}")
    for fmt in ["csv", "parquet"]:
        rules = rule_tables.load_rules(spark, f"{tmp_path}/{fmt}", fmt)
        assert values(rules.override, "MCC_CODE", "rule_order") == [("c1", 1)]


SNAPSHOT = ("CardHolderID string, Email string, FirstName string, LastName string, BirthDate timestamp_ntz, IBAN string, NoMobile string, "
            "Programme string, Address1 string, Address2 string, PostCode string, City string, KYC_Status string, CardStatus string")
BASE = ("e", "Ann", "Doe", T(1980, 1, 1), "i", "1", "p", "1 st", None, "75", "Paris", "KYC", "on")


def snapshot(spark, **cards):
    names = [f.split()[0] for f in SNAPSHOT.split(", ")][1:]
    rows = [(c, *(dict(zip(names, BASE)) | ch).values()) for c, ch in cards.items()]
    return spark.createDataFrame(rows, SNAPSHOT)


def test_a_snapshot_against_itself_has_no_changes(spark):
    s = snapshot(spark, a={}, b={"CardStatus": None, "Email": None})
    for capture in (changes.status_changes, changes.customer_changes, changes.address_changes):
        assert capture(s, s, "2024-03-02").count() == 0


def test_change_capture(spark):
    old = snapshot(spark, a={}, b={}, c={"NoMobile": None}, d={}, gone={})
    new = snapshot(spark, a={"CardStatus": "off", "LastName": "D oe"}, b={"Email": "f", "NoMobile": "2", "City": "Lyon"},
                   c={"NoMobile": ""}, d={"Address1": "1  ST", "CardStatus": None}, new={"City": "Nice"})
    day = T(2024, 3, 1)
    assert values(changes.status_changes(old, new, "2024-03-02"), "CardHolderID", "CardStatus", "dt_change") == [("a", "on", day), ("d", "on", day)]
    got = changes.customer_changes(old, new, "2024-03-02")
    assert values(got, "CardHolderID", "Email", "Is_ch_Email", "Is_ch_NoMobile", "Is_ch_LastName", "total_ch") == [("b", "e", 1, 1, 0, 2)]
    assert values(changes.address_changes(old, new, "2024-03-02"), "CardHolderID", "City", "dt_change") == [("b", "Paris", day), ("new", "Nice", day)]


def test_backfills(spark):
    cards = spark.createDataFrame([("a", None, None), ("b", T(2020, 1, 1), T(2019, 1, 1)), ("c", None, None)],
                                  "CardHolderID string, ActivationDate timestamp_ntz, LastChangeDate timestamp_ntz")
    acts = spark.createDataFrame([("a", T(2024, 1, 2)), ("a", T(2024, 1, 1)), ("b", T(2024, 1, 1))], "CardHolderID string, ActivationTime timestamp_ntz")
    log = spark.createDataFrame([("b", T(2024, 1, 5)), ("b", T(2024, 1, 7))], "CardHolderID string, dt_change timestamp_ntz")
    assert values(changes.fill_activation(cards, acts), "CardHolderID", "ActivationDate") == [("a", T(2024, 1, 1)), ("b", T(2020, 1, 1)), ("c", None)]
    assert values(changes.last_change(cards, log), "CardHolderID", "LastChangeDate") == [("a", None), ("b", T(2024, 1, 7)), ("c", None)]


def test_clusters(spark):
    rows = [(str(i), float(i % 2 * 10 + i * 0.01), float(i % 2)) for i in range(40)]
    df = spark.createDataFrame(rows, "CardHolderID string, a double, b double")
    model, members = clusters.fit_clusters(df, ["a", "b"], 2, seed=1)
    assert values(model.sizes, "cluster_size") == [(20,), (20,)]
    by_card = {r["CardHolderID"]: r["ClusterID"] for r in members.collect()}
    assert len({by_card[str(i)] for i in range(0, 40, 2)}) == 1
    named = clusters.relabel(clusters.relabel(model, {0: "x", 1: "y"}), {"x": "z"}, by="ClusterLabels")
    assert values(named.labels, "ClusterID", "ClusterLabels") == [(0, "z"), (1, "y")]
    scored = clusters.score_clusters(named, df)
    assert all(r["ClusterID"] == by_card[r["CardHolderID"]] for r in scored.collect())
    r = scored.first()
    assert r["std_distance_other_clusters"] == pytest.approx(abs(r["avg_distance_other_clusters"] - r["min_distance"]))
    assert set(named.centers.columns) == {"ClusterID", "a", "b", "ClusterLabels"}
    forest = clusters.explain_clusters(df.join(members, "CardHolderID"), ["a", "b"])
    assert forest.getNumTrees == 50
    top = clusters.feature_importance(spark, forest, ["a", "b"])
    assert sum(r["FeatureImportance"] for r in top.collect()) == pytest.approx(1.0)


def test_top_merchants_breaks_ties_by_name(spark):
    pos = fam.pos(raw(spark, {"shop": "b"}, {"shop": "a"}, {"shop": "c"}, {"shop": "c"}, {"card": "2", "shop": "d"}, {"shop": "e", "time": T(2017, 8, 1)}))
    members = spark.createDataFrame([("1", 3), ("2", 4)], "CardHolderID string, ClusterID int")
    got = merchants.top_merchants(pos, members, 3, "2017-08-01", k=2).collect()
    assert [tuple(r) for r in got] == [("c", 2), ("a", 1)]


def test_top_features_are_the_head_of_all_importances(spark):
    from cardspark.operators import clusters

    rows = [(float(i % 7), float(i % 3), float(i % 2), i % 2) for i in range(200)]
    df = spark.createDataFrame(rows, "a double, b double, c double, label int")
    forest = clusters.explain_clusters(df, ["a", "b", "c"], "label")
    every = [tuple(r) for r in clusters.feature_importance(spark, forest, ["a", "b", "c"]).collect()]
    top = [tuple(r) for r in clusters.feature_importance(spark, forest, ["a", "b", "c"], top=2).collect()]
    assert len(every) == 3 and top == every[:2] and every[0][0] == "c"

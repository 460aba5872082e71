import datetime as dt

from pyspark.sql import functions as F

from cardspark.functions import dates, text, values as val
from cardspark.functions.dates import Period


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column("v").alias("o")).first()["o"]


def test_phone(spark):
    cases = {"0033612": "33612", "33612.0": "33612", "33|6|12": "33612", "330012": "330012", "003300.0": "3300"}
    for raw, clean in cases.items():
        assert one(spark, text.normalize_phone, raw) == clean
    assert one(spark, text.normalize_phone, None) is None


def test_kyc_label(spark):
    for raw, label in {"0": "Anonyme", "1.0": "SDD", "2": "KYC", "3.0": "KYC LITE", "9": "9", "KYC": "KYC"}.items():
        assert one(spark, text.kyc_label, raw) == label
    assert one(spark, text.kyc_label, 2, "int") == "KYC"


def test_dates_with_double_space_and_bad_values(spark):
    assert one(spark, text.long_date, "Jan  5 2019 12:00AM") == dt.datetime(2019, 1, 5)
    assert one(spark, text.long_date, "Nov 15 2018  3:07PM") == dt.datetime(2018, 11, 15, 15, 7)
    assert one(spark, text.long_date, "soon") is None
    assert one(spark, text.expiry_date, "2109") == dt.datetime(2021, 9, 1)
    assert one(spark, text.expiry_date, "2199") is None
    assert one(spark, text.expiry_date, None) is None


def test_person_and_address_key(spark):
    df = spark.createDataFrame(
        [("1980-01-01", "doe", "1 Main  St", None, "75", "Paris"), (None, "doe", "1 main st", "", "75", "PARIS")],
        "BirthDate string, LastName string, Address1 string, Address2 string, PostCode string, City string",
    )
    rows = df.select(text.person_key().alias("p"), text.address_key().alias("a")).collect()
    assert [r["p"] for r in rows] == ["1980-01-01doe", "doe"]
    assert rows[0]["a"] == rows[1]["a"] == "1mainst75paris"


def test_period_bounds_and_months():
    p = Period.months("2019_11", "2020_2")
    assert (p.start, p.end) == (dt.datetime(2019, 11, 1), dt.datetime(2020, 3, 1))
    assert p.last_day == dt.datetime(2020, 2, 29)
    assert p.month_list() == [(2019, 11), (2019, 12), (2020, 1), (2020, 2)]
    assert len(Period.months("2015_1", "2019_12").month_list()) == 60
    assert Period.months("2020_12", "2020_12").end == dt.datetime(2021, 1, 1)


def test_months_before_clamps(spark):
    got = spark.range(1).select(dates.months_before(dt.datetime(2024, 5, 31), 3).alias("o")).first()["o"]
    assert got == dt.datetime(2024, 2, 29)


def test_period_keeps_the_last_day_and_prunes(spark):
    p = Period.months("2024_1", "2024_1")
    df = spark.createDataFrame(
        [(dt.datetime(2024, 1, 31, 23, 59),), (dt.datetime(2024, 2, 1),)], "TransactionTime timestamp_ntz"
    ).withColumns({"year": F.year("TransactionTime"), "month": F.month("TransactionTime")})
    assert dates.period(df, p).count() == 1


def test_calendar_boundaries(spark):
    stamps = [dt.datetime(2024, 1, d, h) for d, h in
              [(7, 0), (7, 4), (8, 5), (14, 11), (15, 12), (21, 14), (22, 15), (31, 19), (6, 20), (6, 23)]]
    df = spark.createDataFrame([(s,) for s in stamps] + [(None,)], "TransactionTime timestamp_ntz")
    got = [(r["jour_moment"], r["mois_moment"], r["is_week_end"]) for r in dates.calendar_buckets(df).collect()]
    assert [g[0] for g in got] == ["nuit", "nuit", "matin", "matin", "midi", "midi", "apres_midi", "apres_midi", "soiree", "soiree", ""]
    assert [g[1] for g in got[:8]] == ["premiere_semaine"] * 2 + ["deuxieme_semaine"] * 2 + ["troisieme_semaine"] * 2 + ["quatrieme_semaine"] * 2
    assert got[0][2] == "week_end" and got[2][2] == "semaine" and got[10] == ("", "", "semaine")


def test_patterns_are_translated(spark):
    cases = [("\\mred\\M", "a RED rod", True), ("\\yred", "hired", False), ("g[[:alpha:]]zmo", "GIZMO", True),
             ("[[:digit:]_]x", "_x", True), ("a.b", "a\nb", True), ("é", "CAFÉ", True)]
    for pattern, name, hit in cases:
        df = spark.createDataFrame([(pattern, name)], "p string, n string")
        assert df.select(F.rlike("n", val.java_pattern("p")).alias("o")).first()["o"] is hit, pattern


def test_ratio(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, None), (1.0, 4.0)], "a double, b double")
    assert [r[0] for r in df.select(val.ratio(F.col("a"), F.col("b"))).collect()] == [0.0, 0.0, 0.25]

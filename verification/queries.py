"""One query per operator over the whole test tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardspark.functions import dates, text
from cardspark.functions.dates import Period, period
from cardspark.operators import (
    age, categorize as cat, changes, clean, clusters, families as fam, identity as idn, kpis, merchants, monthly,
    usage,
)
from cardspark.session import new_path, written
from cardspark.sinks import files, profile, tables
from cardspark.sources import landing, rules as rule_tables
from verification import fixtures as fx

AS_OF = dt.datetime(2024, 2, 15, 6, 0, 0)
JANUARY = Period.months("2024_1", "2024_1")
LONG = Period.months("1995_1", "2001_12")
LONG_AS_OF = dt.datetime(2002, 3, 1)
NEXT_DAY = dt.date(2024, 3, 2)
MCC_VALUES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
BASE_RULES = clean.IdentityRules(
    excluded_emails="u1[0-9]0@", bad_email="u[0-9]*7@", bad_last_name="n1.*3$",
    bad_birth_dates=["1960-06-15 00:00:00", "1970-06-15 00:00:00"], condition="CardStatus <> 'MACHINERY'",
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def keep(f: Query) -> Query:
        QUERIES[name] = f
        return f
    return keep


def tx(spark: SparkSession, d: str) -> DataFrame:
    return fx.view(spark, d, fx.FX_TX)


def tx_long(spark: SparkSession, d: str) -> DataFrame:
    return fx.view(spark, d, fx.FX_TX_LONG)


def cards(spark: SparkSession, d: str) -> DataFrame:
    return fx.view(spark, d, fx.FX_CARDS)


def cards_next(spark: SparkSession, d: str) -> DataFrame:
    return fx.view(spark, d, fx.FX_CARDS_NEXT)


def _inline(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A literal rule table, with the columns and types of `schema`."""
    def one(v: object) -> str:
        return "NULL" if v is None else repr(v) if isinstance(v, int) else "r'" + str(v) + "'"
    names = [c.split()[0] for c in schema.split(", ")]
    body = ", ".join("(" + ", ".join(one(v) for v in r) + ")" for r in rows)
    out = spark.sql(f"SELECT * FROM VALUES {body} AS t({', '.join(names)})")
    return out.select(*[F.col(c.split()[0]).cast(c.split()[1]) for c in schema.split(", ")])


def types(spark: SparkSession) -> DataFrame:
    return _inline(spark, fx.TYPES, "TransactionTP string, group_transactions string, IsVolontaire int")


def rules(spark: SparkSession) -> rule_tables.Rules:
    return rule_tables.prepare_rules(
        _inline(spark, fx.CATEGORIES,
                "UNIVERS_DATABASE string, SOUS_UNIVERS_DATABASE string, UNIVERS string, SOUS_UNIVERS string"),
        _inline(spark, fx.MCC_LINK, "MCC_CODE string, MCC string"),
        _inline(spark, fx.MCC_CATEGORIES, "MCC_NAME string, SOUS_UNIVERS string, UNIVERS string, MCC_CODE string, NOTE int"),
        _inline(spark, fx.OVERRIDE, "MCC string, UNIVERS string, SOUS_UNIVERS string, NEW_REGEX string, rule_order int"),
        _inline(spark, fx.FILL, "UNIVERS string, SOUS_UNIVERS string, NEW_REGEX string, rule_order int"),
    )


# --- families -----------------------------------------------------------------------------

for _name, _split in fam.FAMILIES.items():
    QUERIES[f"family_{_name}"] = lambda spark, d, _split=_split: _split(tx(spark, d))


@query("family_pos_day")
def _(spark, d):
    """One day increment; `year` and `month` stand for the folders of the raw table."""
    return fam.pos(tables.with_month(tx(spark, d)), dt.date(2024, 1, 10))


@query("money_class")
def _(spark, d):
    return fam.money_class(tx(spark, d)).select(
        "TransactionID", *[F.col(c).cast("int").alias(c) for c in
                           ["is_fee_debit", "is_real_debit", "is_refunded_fee", "is_credit"]]
    )


@query("period_filter")
def _(spark, d):
    out = period(tx_long(spark, d), Period.months("1996_11", "1997_2"))
    return out.select("TransactionID", "CardHolderID", "TransactionTime", F.col("Amount").cast("double").alias("Amount"))


# --- indicators ---------------------------------------------------------------------------

def _families(raw: DataFrame) -> dict[str, DataFrame]:
    return {"pos": fam.pos(raw), "atm": fam.atm(raw), "other": fam.other(raw), "load": fam.loads(raw), "fees": fam.fees(raw)}


for _kind in ["atm", "pos", "other", "load"]:
    QUERIES["family_kpis_" + {"load": "loads"}.get(_kind, _kind)] = (
        lambda spark, d, _kind=_kind: kpis.family_kpis(_families(tx(spark, d))[_kind], _kind, JANUARY, AS_OF)
    )


@query("family_monthly_kpis")
def _(spark, d):
    return kpis.family_monthly_kpis(fam.pos(tx_long(spark, d)), "pos", LONG)


@query("fee_kpis")
def _(spark, d):
    return kpis.fee_kpis(fam.fees(tx(spark, d)), JANUARY)


@query("spend_mix")
def _(spark, d):
    f = _families(tx(spark, d))
    sets = [kpis.family_kpis(f[k], k, JANUARY, AS_OF).select("CardHolderID", f"sum_amount_{k}") for k in ("atm", "pos", "other")]
    return kpis.spend_mix(kpis.attach(cards(spark, d), *sets))


@query("spend_last_months")
def _(spark, d):
    raw = tx_long(spark, d)
    return kpis.spend_last_months(fam.pos(raw), fam.other(raw), fam.atm(raw), Period.months("1995_1", "2001_3"))


@query("loads_last_months")
def _(spark, d):
    return kpis.loads_last_months(fam.loads(tx(spark, d)), JANUARY)


@query("type_counts")
def _(spark, d):
    f = _families(tx(spark, d))
    return kpis.type_counts({k: v for k, v in f.items() if k != "fees"}, types(spark), JANUARY)


@query("card_kpis")
def _(spark, d):
    return kpis.card_kpis(_families(tx(spark, d)), cards(spark, d), types(spark), JANUARY, AS_OF)


@query("last_action")
def _(spark, d):
    raw = tx(spark, d)
    sets = [kpis.family_kpis(v, k, JANUARY, AS_OF).select("CardHolderID", kpis.LAST_TIME[k])
            for k, v in _families(raw).items() if k != "fees"]
    out = kpis.attach(cards(spark, d), *sets, kpis.fee_kpis(fam.fees(raw), JANUARY).select("CardHolderID", "dernier_fees"))
    return kpis.last_action(out)


# --- months, usage, age -------------------------------------------------------------------

@query("calendar_buckets")
def _(spark, d):
    return dates.calendar_buckets(tx(spark, d).select("TransactionID", "TransactionTime"))


@query("month_features")
def _(spark, d):
    return monthly.month_features(tx(spark, d))


@query("debit_buckets")
def _(spark, d):
    return monthly.debit_bucket_counts(tx(spark, d))


@query("end_balance")
def _(spark, d):
    return monthly.end_balance(tx_long(spark, d))


@query("latest_rows")
def _(spark, d):
    out = tx_long(spark, d).select("CardHolderID", "TransactionTime", "TransactionID", F.col("Amount").cast("double").alias("Amount"))
    return monthly.latest_rows(out, "CardHolderID", "TransactionTime")


@query("monthly_kpis")
def _(spark, d):
    return monthly.monthly_kpis(tx(spark, d))


@query("rollup_months")
def _(spark, d):
    return _rounded(monthly.rollup_months(tx_long(spark, d)))


@query("normalize_rollup")
def _(spark, d):
    return _rounded(monthly.normalize_rollup(monthly.rollup_months(tx_long(spark, d))))


@query("align_tables")
def _(spark, d):
    a = monthly.debit_bucket_counts(tx(spark, d))
    b = monthly.debit_bucket_counts(tx_long(spark, d))
    return monthly.align(a, b)


def _rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(*[F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


@query("weighted_age")
def _(spark, d):
    raw = tx_long(spark, d)
    return _rounded(age.weighted_age(fam.pos(raw), fam.atm(raw), fam.other(raw), cards(spark, d)))


@query("usage_amount")
def _(spark, d):
    return usage.usage(fam.pos(tx_long(spark, d)), "MCC", "amount_paid", LONG, MCC_VALUES)


@query("usage_frequency")
def _(spark, d):
    return usage.usage(fam.pos(tx_long(spark, d)), "MCC", "frequency", Period.months("1998_1", "1999_6"))


@query("usage_share")
def _(spark, d):
    return usage.usage_share(usage.usage(fam.pos(tx_long(spark, d)), "MCC", "amount_paid", LONG, MCC_VALUES))


@query("usage_summary")
def _(spark, d):
    return usage.usage_summary(usage.usage(fam.pos(tx_long(spark, d)), "MCC", "amount_paid", LONG, MCC_VALUES), "MCC")


# --- categories ---------------------------------------------------------------------------

_CATEGORY = ["TransactionID", "CardHolderID", "TransactionTime", "MCC", "MerchantName", "UNIVERS", "SOUS_UNIVERS"]


@query("categorize_mcc")
def _(spark, d):
    return cat.categorize_mcc(fam.pos(tx_long(spark, d)), rules(spark), cat.FIRST_NOTES).select(*_CATEGORY)


@query("categorize_override")
def _(spark, d):
    return cat.categorize_override(fam.pos(tx_long(spark, d)), rules(spark), cat.FIRST_NOTES).select(*_CATEGORY)


@query("categorize_fill")
def _(spark, d):
    return cat.categorize_fill(fam.pos(tx_long(spark, d)), rules(spark)).select(*_CATEGORY)


@query("categorize")
def _(spark, d):
    return cat.categorize(fam.pos(tx_long(spark, d)), rules(spark)).select(*_CATEGORY)


@query("usage_of_categories")
def _(spark, d):
    done = cat.categorize(fam.pos(tx_long(spark, d)), rules(spark))
    return usage.usage(done, "UNIVERS", "frequency", LONG, ["FOOD", "HOME", "LEISURE", "OTHER", "TRAVEL"])


# --- snapshots and changes ----------------------------------------------------------------

@query("status_changes")
def _(spark, d):
    return changes.status_changes(cards(spark, d), cards_next(spark, d), NEXT_DAY)


@query("customer_changes")
def _(spark, d):
    return changes.customer_changes(cards(spark, d), cards_next(spark, d), NEXT_DAY)


@query("address_changes")
def _(spark, d):
    return changes.address_changes(cards(spark, d), cards_next(spark, d), NEXT_DAY)


def _log(spark, d):
    first = changes.status_changes(cards(spark, d), cards_next(spark, d), NEXT_DAY)
    second = changes.customer_changes(cards(spark, d), cards_next(spark, d), NEXT_DAY + dt.timedelta(days=7))
    return first.select("CardHolderID", "dt_change").unionByName(second.select("CardHolderID", "dt_change"))


@query("last_change")
def _(spark, d):
    return changes.last_change(cards(spark, d), _log(spark, d)).select("CardHolderID", "LastChangeDate")


@query("fill_activation")
def _(spark, d):
    acts = tx_long(spark, d).select("CardHolderID", F.col("TransactionTime").alias("ActivationTime"))
    return changes.fill_activation(cards(spark, d), acts).select("CardHolderID", "ActivationDate")


@query("clean_transactions")
def _(spark, d):
    raw = fx.view(spark, d, fx.FX_RAW).withColumn("FileSource", F.concat("f1", "f2", "f3")).drop("f1", "f2", "f3")
    missing = ["AuthNum", "CardNumber", "CardProductName", "CardVPUType", "Currency", "CurrencyCode", "DebitCredit",
               "LastName", "MCC", "MerchantAddress", "MerchantCity", "MerchantCountry", "MerchantID", "MerchantName",
               "ProgramName", "PurseCurrency", "SweepCurrency", "TermState", "TransactionDB/CR", "TransactionResult",
               "TransactionTP", "Fee", "Rate", "RemainingBalance", "Surcharge"]
    raw = raw.withColumns({c: F.lit(None).cast("string") for c in missing})
    raw = raw.withColumnRenamed("TransactionID", "Transaction ID")
    return clean.clean_transactions(raw).select(
        "TransactionID", "CardHolderID", "TransactionTime", "Amount", "CardType", "FileSource", "Description", "DistributorCode"
    )


@query("clean_activations")
def _(spark, d):
    rows = fx.view(spark, d, fx.FX_TX).select(
        F.concat(F.lit("'"), "CardHolderID", F.lit("'")).alias("CardholderID"),
        F.date_format("TransactionTime", "dd/MM/yyyy HH:mm:ss").alias("ActivationTime"),
        F.lit("a_20240101.csv").alias("FileSource"),
    )
    return clean.clean_activations(rows)


@query("clean_card_status")
def _(spark, d):
    return clean.clean_card_status(fx.view(spark, d, fx.FX_STATUS_FILE)).select(
        "CardHolderID", "CardStatus", "Email", "NoMobile", "KYC_Status", "AvailableBalance", "DistributorCode",
        "BirthDate", "CreationDate", "UpdateDate", "ExpirationDate", "IsExcludedAddress", "IsRenewal",
    )


@query("clean_change_snapshot")
def _(spark, d):
    return clean.clean_change_snapshot(fx.view(spark, d, fx.FX_STATUS_FILE))


@query("text_keys")
def _(spark, d):
    return cards_next(spark, d).select(
        "CardHolderID", text.person_key().alias("person"), text.address_key().alias("address"),
        text.normalize_phone(F.concat(F.lit("00"), "NoMobile", F.lit("|.0"))).alias("phone"),
    )


# --- identity -----------------------------------------------------------------------------

def _early(base: DataFrame) -> DataFrame:
    """Cards known on the first day of the two-day identity scenario."""
    return base.filter(F.col("CardHolderID").cast("long") % 7 < 4)


def _late(base: DataFrame) -> DataFrame:
    return base.filter(F.col("CardHolderID").cast("long") % 7 >= 4)


@query("identity_base")
def _(spark, d):
    return idn.identity_base(cards(spark, d).drop("GoodEmail", "GoodCombinaison"), BASE_RULES)


@query("cards_per_phone")
def _(spark, d):
    return idn.cards_per_phone(cards(spark, d))


@query("phone_ids")
def _(spark, d):
    base = cards(spark, d)
    first = written(idn.phone_ids(_early(base)), "phones")
    return idn.phone_ids(base, first)


@query("person_ids")
def _(spark, d):
    base = cards(spark, d)
    first = written(idn.person_keys(_early(base)), "persons")
    return idn.person_keys(base, first)


@query("contact_ambiguity")
def _(spark, d):
    return idn.contact_ambiguity(cards(spark, d))


@query("ambiguous_contacts")
def _(spark, d):
    return idn.ambiguous_contacts(idn.contact_ambiguity(cards(spark, d)))


@query("resolve_users")
def _(spark, d):
    return idn.resolve_users(cards(spark, d))


@query("bootstrap_users")
def _(spark, d):
    return idn.bootstrap_users(cards_next(spark, d).withColumns({"GoodEmail": F.lit(1), "GoodCombinaison": F.lit(0)}))


def _scenario(spark, d):
    """Users of the first day, then the rest of the cards arriving."""
    base = cards(spark, d)
    known = written(idn.resolve_users(_early(base)), "users")
    return base, known


@query("resolve_incremental")
def _(spark, d):
    base, known = _scenario(spark, d)
    return idn.resolve_incremental(known, idn.contacts_of(_late(base)))


@query("conflicting_keys")
def _(spark, d):
    """Two separate builds put together: keys that were given two ids."""
    base = cards(spark, d)
    first = written(idn.resolve_users(_early(base)), "users")
    second = written(idn.resolve_users(_late(base), last_id=1_000_000), "users")
    return idn.conflicting_keys(first.unionByName(second))


def _masters(spark, d):
    base, known = _scenario(spark, d)
    phones1 = written(idn.phone_ids(_early(base)), "phones")
    persons1 = written(idn.person_keys(_early(base)), "persons")
    master1 = written(idn.master(_early(base), known, phones1, persons1), "master")
    users2 = written(idn.resolve_incremental(known, idn.contacts_of(_late(base))), "users")
    phones2, persons2 = idn.phone_ids(base, phones1), idn.person_keys(base, persons1)
    master2 = written(idn.master(_late(base), users2, phones2, persons2, master1), "master")
    return master1, master2, users2, known


_MASTER = ["CardHolderID", "NoMobile", "Email", "LastName", "GoodEmail", "GoodCombinaison", "MOBILE_ID", "USER_ID",
           "CONTACT_ID", "PERSON_ID"]


@query("master")
def _(spark, d):
    return _masters(spark, d)[1].select(*_MASTER)


@query("user_changes")
def _(spark, d):
    master1, master2, _users, _known = _masters(spark, d)
    return idn.user_changes(master1, master2, AS_OF).select(*_MASTER, "dt_change")


def _propagated(spark, d):
    master1, master2, users2, known = _masters(spark, d)
    log = idn.user_changes(master1, master2, AS_OF)
    # users written before the merge still carry old ids: the situation the step repairs
    stale = users2.unionByName(known)
    return idn.propagate_changes(log, stale, master2, AS_OF)


@query("bootstrap_users_keys")
def _(spark, d):
    """First build over cards with good and bad e-mails and person keys."""
    return idn.bootstrap_users(cards(spark, d))


@query("propagate_log")
def _(spark, d):
    return _propagated(spark, d)[1].select(*_MASTER, "dt_change")


@query("propagate_users")
def _(spark, d):
    return _propagated(spark, d)[0]


@query("propagate_master")
def _(spark, d):
    return _propagated(spark, d)[2].select(*_MASTER)


@query("attach_users")
def _(spark, d):
    """Users known from early phones only: the rest is found by person key."""
    base, known = _scenario(spark, d)
    rows = base.withColumn("USER_ID", F.lit(None).cast("long"))
    return idn.attach_users(rows, known).select("CardHolderID", "NoMobile", "USER_ID")


@query("cards_to_resolve")
def _(spark, d):
    old, new = cards(spark, d), cards_next(spark, d)
    known = old.select("CardHolderID", F.when(F.col("GoodEmail") == 1, 1).cast("long").alias("USER_ID"))
    log = changes.customer_changes(old, new, NEXT_DAY)
    when = dt.datetime(2024, 3, 2, 5, 0)
    return idn.cards_to_resolve(new, known, log, when, BASE_RULES).select("CardHolderID", "NoMobile", "Email")


# --- clusters and merchants ---------------------------------------------------------------

_DIMS = 64
_CENTERS = [[0.05 * ((i * 7 + j * 3) % 11 - 5) for j in range(_DIMS)] for i in range(4)]
_COLUMNS = [f"e{j}" for j in range(_DIMS)]


def _embedded(spark, d, dims=_DIMS):
    df = spark.read.parquet(f"{d}/embeddings.parquet")
    return df.select(F.col("vec_id").cast("string").alias("CardHolderID"),
                     *[F.col("embedding")[j].cast("double").alias(f"e{j}") for j in range(dims)])


@query("score_clusters")
def _(spark, d):
    return _rounded(clusters.score_with_centers(_embedded(spark, d), clusters.features(_COLUMNS), _CENTERS))


@query("distance_distribution")
def _(spark, d):
    scored = clusters.score_with_centers(_embedded(spark, d), clusters.features(_COLUMNS), _CENTERS)
    return _rounded(clusters.distance_distribution(scored))


def _fitted(spark, d):
    data = _embedded(spark, d)
    model, members = clusters.fit_clusters(data, _COLUMNS, 4, seed=7)
    return data, clusters.relabel(model, {0: "first"}), members


@query("clusters")
def _(spark, d):
    """What must hold of any fit, worked out over all rows."""
    return clusters.fit_properties(*_fitted(spark, d)).agg(
        F.count("*").alias("n_clusters"), F.sum("n_members").alias("n_members"),
        *[F.min(c).alias(c) for c in ("size_agrees", "all_nearest", "centre_is_mean", "one_label")])


@query("clusters_scored")
def _(spark, d):
    data, model, _members = _fitted(spark, d)
    return clusters.score_clusters(model, data)


@query("feature_importance")
def _(spark, d):
    data = _embedded(spark, d).join(
        spark.read.parquet(f"{d}/embeddings.parquet").select(F.col("vec_id").cast("string").alias("CardHolderID"), "label"),
        "CardHolderID",
    )
    forest = clusters.explain_clusters(data, _COLUMNS, "label")
    found = clusters.feature_importance(spark, forest, _COLUMNS)
    return found.agg(
        F.count("*").alias("n_rows"), F.countDistinct("feature").alias("n_features"),
        F.round(F.sum("FeatureImportance"), 6).alias("total"), F.min(F.col("FeatureImportance") >= 0).alias("none_below_0"),
        F.max(F.col("FeatureImportance") > 0).alias("some_above_0"))


@query("feature_importance_top")
def _(spark, d):
    """TOP-2: the ten columns that explain the labels most, with their importances (a forest: no SQL)."""
    data = _embedded(spark, d).join(
        spark.read.parquet(f"{d}/embeddings.parquet").select(F.col("vec_id").cast("string").alias("CardHolderID"), "label"),
        "CardHolderID",
    )
    forest = clusters.explain_clusters(data, _COLUMNS, "label")
    return clusters.feature_importance(spark, forest, _COLUMNS, top=10)


@query("top_merchants")
def _(spark, d):
    members = cards(spark, d).select(
        "CardHolderID", (F.col("CardHolderID").cast("long") % 5).cast("int").alias("ClusterID")
    )
    return merchants.top_merchants(fam.pos(tx_long(spark, d)), members, 3, "1997-08-01")


# --- files and tables ---------------------------------------------------------------------

@query("infer_column_types")
def _(spark, d):
    return profile.infer_column_types(spark.read.parquet(f"{d}/part.parquet"), {"p_brand": "TEXT"})


@query("table_profile")
def _(spark, d):
    return profile.table_profile(spark.read.parquet(f"{d}/part.parquet"))


def _table_name(label: str) -> str:
    return f"cardspark_{label}_{new_path_suffix()}"


def new_path_suffix() -> str:
    import uuid
    return uuid.uuid4().hex


@query("landing_days")
def _(spark, d):
    """Day and window of file names of all three kinds, made from the order dates."""
    days = spark.read.parquet(f"{d}/orders.parquet").select(F.col("o_orderdate").cast("date").alias("day")).distinct()
    kinds = {"transactions": ("A_", "ddMMyy", "_1.csv"), "activations": ("report_", "yyyyMMdd", "12.csv"),
             "status": ("cards-", "yyyy-MM-dd", ".csv")}
    out = None
    for kind, (before, pattern, after) in kinds.items():
        name = F.concat(F.lit(before), F.date_format("day", pattern), F.lit(after))
        year = 2096 if kind == "transactions" else 1996  # their names have two digits, read as 20YY
        part = days.select(name.alias("file_name")).select(
            F.lit(kind).alias("kind"), "file_name", landing.file_day(F.col("file_name"), kind).alias("file_day"),
            landing.in_window(F.col("file_name"), kind, dt.date(year, 1, 1), dt.date(year, 12, 31)).alias("inside"))
        out = part if out is None else out.unionByName(part)
    return out


@query("export_and_read")
def _(spark, d):
    rows = tx(spark, d).select("TransactionID", "CardHolderID", F.col("Amount").cast("double").alias("Amount"), "MerchantName")
    folder = files.export_csv(rows, new_path(spark, "export"), dt.date(2024, 2, 1), compression="gzip")
    reader = spark.read.schema(rows.schema).option("header", True).option("sep", ";").option("mode", "FAILFAST")
    return reader.csv(folder)


@query("ingest_files")
def _(spark, d):
    rows = tx(spark, d).select("TransactionID", "CardHolderID", F.col("Amount").cast("double").alias("Amount"))
    folder = files.export_csv(rows, new_path(spark, "landing"), dt.date(2024, 2, 1), sep=",")
    name = _table_name("ingest")

    def hook(df, factor):
        return df.select("TransactionID", "CardHolderID", (F.col("Amount") * factor).alias("Amount"))

    files.ingest_files(spark, folder, name, hook, {"factor": 2}, path=new_path(spark, "ingested"), schema=rows.schema)
    return spark.table(name)


@query("ingest_file_per_table")
def _(spark, d):
    rows = tx(spark, d).select("TransactionID", "CardHolderID")
    folder = files.export_csv(rows, new_path(spark, "landing"), dt.date(2024, 2, 1), sep=",")
    root = new_path(spark, "tables")
    files.ingest_file_per_table(spark, folder, root, schema=rows.schema)
    files.ingest_file_per_table(spark, folder, root, schema=rows.schema)
    return spark.read.schema("TransactionID string, CardHolderID string, file_stem string").parquet(root).select("TransactionID", "CardHolderID")


@query("archive_copy")
def _(spark, d):
    rows = tx(spark, d).select("TransactionID", "CardHolderID")
    folder = new_path(spark, "archive")
    files.archive_copy(rows, folder)
    return landing.read_csv(spark, folder, rows.schema)


@query("write_monthly")
def _(spark, d):
    name = _table_name("monthly")
    rows = tx_long(spark, d).select("TransactionID", "CardHolderID", "TransactionTime", F.col("Amount").cast("double").alias("Amount"))
    tables.write_monthly(rows, name, new_path(spark, "monthly"))
    return spark.table(name).select(*rows.columns, "year", "month")


@query("read_months")
def _(spark, d):
    """A period of a table in month folders; only its folders are read."""
    name = _table_name("monthly")
    rows = tx_long(spark, d).select("TransactionID", "CardHolderID", "TransactionTime", F.col("Amount").cast("double").alias("Amount"))
    tables.write_monthly(rows, name, new_path(spark, "monthly"))
    return period(spark.table(name), Period.months("1996_1", "1996_3")).select(*rows.columns, "year", "month")


@query("usage_cells")
def _(spark, d):
    """Every merchant as a category, without a bound."""
    return usage.usage_cells(fam.pos(tx_long(spark, d)), "MerchantID", "amount_paid", LONG)


@query("append_day")
def _(spark, d):
    """Two batches that overlap by days, appended twice: every day arrives once."""
    name = _table_name("days")
    path = new_path(spark, "days")
    rows = fam.atm(tx(spark, d)).select("TransactionID", "CardHolderID", "TransactionTime")
    tables.write_monthly(period(rows, Period(dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 16))), name, path)
    for _ in range(2):
        tables.write_monthly(tables.append_day(spark.table(name).drop("year", "month"), rows), name, path)
    for _ in range(2):
        tables.append_day_to_table(rows, name, dt.date(2024, 1, 20), path)
    return spark.table(name).drop("year", "month")


@query("refresh_snapshot")
def _(spark, d):
    """A snapshot replaced by rows computed from itself."""
    name = _table_name("snapshot")
    root = new_path(spark, "snapshot")
    tables.refresh_snapshot(cards(spark, d).select("CardHolderID", "NoMobile", "KYC_Status"), name, root)
    now = spark.table(name).withColumn("KYC_Status", F.lit("SDD")).filter(F.col("NoMobile") != "3360")
    tables.refresh_snapshot(now, name, root)
    return spark.table(name)


@query("write_table")
def _(spark, d):
    name = _table_name("plain")
    path = new_path(spark, "plain")
    rows = tx(spark, d).select("CardHolderID", "TransactionTP", F.col("Amount").cast("double").alias("Amount"))
    empty = tables.create_table(spark, name, rows.schema, keep_order=True, path=path)
    assert [f.name for f in tables.schema_like(spark, name)] == empty.columns
    tables.write_table(rows, name, "append", path=path)
    tables.write_table(rows, name, "append", path=path)
    return spark.table(name)

"""Merchant categories by merchant code and by ordered pattern rules.

Patterns are tried on the dictionary of distinct (MCC, MerchantName) pairs, not
on the transactions. The rules of a merchant code travel as one sorted array on
its code, so a pair meets all its rules in one row and nothing is multiplied;
the result returns to the transactions by a join that stays balanced when one
merchant holds a large share of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardspark.functions.values import java_pattern
from cardspark.operators.lookup import lookup, small
from cardspark.session import written
from cardspark.operators.numbering import number_rows
from cardspark.sources.rules import Rules

PAIR = ["MCC", "MerchantName"]
FIRST_NOTES = (1,)
SECOND_NOTES = (0, 2)
RULES_PER_PASS = 20_000
BROADCAST_BYTES = 32 << 20


def _label(rules: DataFrame, categories: DataFrame) -> DataFrame:
    """Replace the working category names by the ones stored in the warehouse."""
    names = categories.select(
        "UNIVERS", "SOUS_UNIVERS", F.col("UNIVERS_DATABASE").alias("__u"), F.col("SOUS_UNIVERS_DATABASE").alias("__s")
    )
    return rules.join(names, ["UNIVERS", "SOUS_UNIVERS"])


def mcc_rules(rules: Rules, notes: Sequence[int]) -> DataFrame:
    """(MCC, category) for the given NOTE values, one row per MCC."""
    wanted = rules.mcc_categories.filter(F.col("NOTE").isin(list(notes)))
    named = _label(wanted.join(rules.mcc_link, "MCC_CODE"), rules.categories)
    return named.groupBy("MCC").agg(F.min(F.struct("__u", "__s")).alias("__category"))


def override_rules(rules: Rules, notes: Sequence[int]) -> DataFrame:
    """(MCC, sorted array of rules) for the given NOTE values."""
    codes = rules.mcc_categories.filter(F.col("NOTE").isin(list(notes))).select("MCC_CODE").distinct()
    listed = rules.override.drop("MCC").join(codes, "MCC_CODE").join(rules.mcc_link, "MCC_CODE")
    named = _label(listed, rules.categories).select(
        "MCC", F.struct(F.col("rule_order"), java_pattern("NEW_REGEX").alias("regex"), "__u", "__s").alias("rule")
    )
    return named.groupBy("MCC").agg(F.sort_array(F.collect_list("rule")).alias("__rules"))


def _hits(rules: Column) -> Column:
    return F.filter(rules, lambda r: F.rlike(F.col("MerchantName"), r["regex"]))


def _category(rule: Column) -> Column:
    return F.when(rule.isNotNull(), F.struct(rule["__u"].alias("__u"), rule["__s"].alias("__s")))


def code_rules(rules: Rules, notes: Sequence[int], suffix: str = "") -> DataFrame:
    """Everything a merchant code decides in one row: its category and its override rules."""
    both = mcc_rules(rules, notes).join(override_rules(rules, notes), "MCC", "full")
    return both.select("MCC", F.col("__category").alias(f"__c{suffix}"), F.col("__rules").alias(f"__r{suffix}"))


def _last_hit(rules: str) -> Column:
    return _category(F.try_element_at(_hits(F.col(rules)), F.lit(-1)))


def _fill_passes(rules: Rules) -> list[DataFrame]:
    """Fill rules in order, split into passes that are small enough to ship whole."""
    named = _label(rules.fill, rules.categories).select(
        F.struct("rule_order", java_pattern("NEW_REGEX").alias("regex"), "__u", "__s").alias("rule")
    )
    count = named.count()
    if count <= RULES_PER_PASS:
        return [named]
    numbered = number_rows(named.distinct(), ["rule"], "__n")
    passes = -(-count // RULES_PER_PASS)
    return [
        numbered.filter((F.col("__n") > i * RULES_PER_PASS) & (F.col("__n") <= (i + 1) * RULES_PER_PASS))
        for i in range(passes)
    ]


def _with_fill(pairs: DataFrame, rules: Rules) -> DataFrame:
    """Adds `__category` of the first matching fill rule.

    The rules of a pass become one array value of a scalar subquery: there is
    no join and the pairs stay where they are.
    """
    found: Column = F.lit(None).cast("struct<__u:string,__s:string>")
    for one in _fill_passes(rules):
        array = one.agg(F.sort_array(F.collect_list("rule")).alias("rules")).scalar()
        pairs = pairs.withColumn("__fill", array)
        pairs = pairs.withColumn("__found", F.coalesce(found, _category(F.try_element_at(_hits(F.col("__fill")), F.lit(1)))))
        pairs = pairs.drop("__fill")
        found = F.col("__found")
    return pairs.withColumnRenamed("__found", "__category")


def _pairs(tx: DataFrame) -> DataFrame:
    return tx.groupBy(*PAIR).agg(F.count("*").alias("__rows"))


def _back(tx: DataFrame, pairs: DataFrame, decided: Column, open_rows: Column | None = None) -> DataFrame:
    """Bring `__category` from the dictionary to the transactions.

    Only pairs that got a category travel. Their bytes are measured: up to
    `BROADCAST_BYTES` they are sent to every executor and the transactions stay
    where they are. Beyond that, rows are shuffled, but none that cannot change:
    only those for which `open_rows` holds, if given.
    """
    table = written(pairs.filter(decided).select(*PAIR, "__rows", "__category"), "decided")
    texts = [c for c, t in table.select(*PAIR, "__category.*").dtypes if t == "string"]
    flat = table.select(*PAIR, "__category.*")
    size = flat.agg(F.sum(
        sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in texts), F.lit(128)))).first()[0] or 0
    if size <= BROADCAST_BYTES:
        ours, theirs = tx, F.broadcast(table.select(*[F.col(c).alias(f"__k_{c}") for c in PAIR], "__category"))
        same = [ours[c].eqNullSafe(F.col(f"__k_{c}")) for c in PAIR]
        return ours.join(theirs, same[0] & same[1], "left").drop(*[f"__k_{c}" for c in PAIR])
    if open_rows is None:
        return lookup(tx, table, PAIR, "__rows", null_safe=True)
    closed = tx.filter(~F.coalesce(open_rows, F.lit(False))).withColumn(
        "__category", F.lit(None).cast(table.schema["__category"].dataType))
    return lookup(tx.filter(open_rows), table, PAIR, "__rows", null_safe=True).unionByName(closed)


def _assign(tx: DataFrame, category: Column, where: Column | None = None) -> DataFrame:
    take = category.isNotNull() if where is None else where & category.isNotNull()
    return tx.withColumns({
        "UNIVERS": F.when(take, category["__u"]).otherwise(F.col("UNIVERS")),
        "SOUS_UNIVERS": F.when(take, category["__s"]).otherwise(F.col("SOUS_UNIVERS")),
    })


def _uncategorised() -> Column:
    return (F.col("UNIVERS") == "") & (F.col("SOUS_UNIVERS") == "")


def categorize_mcc(tx: DataFrame, rules: Rules, notes: Sequence[int] = FIRST_NOTES) -> DataFrame:
    """Category of the merchant code; a code without one keeps what was there."""
    joined = tx.join(small(mcc_rules(rules, notes)), "MCC", "left")
    return _assign(joined, F.col("__category")).select(*tx.columns)


def categorize_override(tx: DataFrame, rules: Rules, notes: Sequence[int] = FIRST_NOTES) -> DataFrame:
    """Rules on (MCC, merchant name); the last matching one replaces the category."""
    pairs = _pairs(tx).join(small(override_rules(rules, notes)), "MCC", "left")
    joined = _back(tx, pairs.withColumn("__category", _last_hit("__rules")), F.col("__category").isNotNull())
    return _assign(joined, F.col("__category")).select(*tx.columns)


def categorize_fill(tx: DataFrame, rules: Rules) -> DataFrame:
    """Rules on the merchant name, for rows without category; the first match wins."""
    open_rows = tx.filter(_uncategorised())
    joined = _back(tx, _with_fill(_pairs(open_rows), rules), F.col("__category").isNotNull(), _uncategorised())
    return _assign(joined, F.col("__category"), _uncategorised()).select(*tx.columns)


def categorize(tx: DataFrame, rules: Rules) -> DataFrame:
    """All five passes, computed once per distinct pair.

    Each pass of codes and override rules replaces what an earlier one set, so
    the last one that decides counts; the fill rules apply where none did.
    """
    by_code = code_rules(rules, FIRST_NOTES, "1").join(code_rules(rules, SECOND_NOTES, "2"), "MCC", "full")
    pairs = _pairs(tx).join(small(by_code), "MCC", "left")
    decided = F.coalesce(_last_hit("__r2"), F.col("__c2"), _last_hit("__r1"), F.col("__c1"))
    pairs = _with_fill(pairs.withColumn("__decided", decided), rules)
    pairs = pairs.withColumn("__category", F.struct("__decided", F.col("__category").alias("__filled")))
    some = F.col("__category.__decided").isNotNull() | F.col("__category.__filled").isNotNull()
    joined = _back(tx, pairs, some)
    done = _assign(joined, F.col("__category.__decided"))
    return _assign(done, F.col("__category.__filled"), _uncategorised()).select(*tx.columns)

"""Categorisation reference tables."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardspark.functions.values import java_pattern


@dataclass(frozen=True)
class Rules:
    """The five rule tables; `override` and `fill` carry an int `rule_order`."""

    categories: DataFrame      # UNIVERS_DATABASE, SOUS_UNIVERS_DATABASE, UNIVERS, SOUS_UNIVERS
    mcc_link: DataFrame        # MCC_CODE, MCC
    mcc_categories: DataFrame  # MCC_NAME, SOUS_UNIVERS, UNIVERS, MCC_CODE, NOTE
    override: DataFrame        # MCC, UNIVERS, SOUS_UNIVERS, NEW_REGEX, MCC_CODE, rule_order
    fill: DataFrame            # UNIVERS, SOUS_UNIVERS, NEW_REGEX, rule_order


def rules_with_code(override: DataFrame, mcc_categories: DataFrame) -> DataFrame:
    """Fill MCC_CODE of the override rules from the merchant-code name."""
    codes = mcc_categories.groupBy(F.col("MCC_NAME").alias("MCC")).agg(F.min("MCC_CODE").alias("__code"))
    out = override if "MCC_CODE" in override.columns else override.withColumn("MCC_CODE", F.lit(None).cast("string"))
    return (
        out.join(codes, "MCC", "left")
        .withColumn("MCC_CODE", F.coalesce("__code", "MCC_CODE"))
        .drop("__code")
    )


def check_patterns(*rules: DataFrame, column: str = "NEW_REGEX") -> None:
    """Compile every pattern in one job over the rule tables.

    An invalid one fails here with its text, before any transaction is read.
    """
    named = F.col("UNIVERS").isNotNull()
    patterns = reduce(
        DataFrame.unionAll, [r.select(F.when(named, java_pattern(column)).alias("p")) for r in rules]
    )
    patterns.filter(F.rlike(F.lit(""), F.col("p"))).count()


def prepare_rules(
    categories: DataFrame, mcc_link: DataFrame, mcc_categories: DataFrame, override: DataFrame, fill: DataFrame
) -> Rules:
    """Drop rule rows without a category, complete the codes and check the patterns."""
    override = rules_with_code(override.filter(F.col("UNIVERS").isNotNull()), mcc_categories)
    fill = fill.filter(F.col("UNIVERS").isNotNull())
    check_patterns(override, fill)
    return Rules(categories, mcc_link, mcc_categories, override, fill)


def load_rules(spark: SparkSession, folder: str, fmt: str = "parquet") -> Rules:
    """Read the five tables from sub-folders of `folder` (Parquet, or CSV with a header)."""
    def table(name: str) -> DataFrame:
        path = f"{folder.rstrip('/')}/{name}"
        return spark.read.option("header", True).csv(path) if fmt == "csv" else spark.read.parquet(path)

    def ordered(df: DataFrame) -> DataFrame:
        return df.withColumn("rule_order", F.col("rule_order").cast("int"))

    mcc_categories = table("mcc_categories").withColumn("NOTE", F.col("NOTE").cast("int"))
    return prepare_rules(
        table("categories"), table("mcc_link"), mcc_categories, ordered(table("override")), ordered(table("fill"))
    )

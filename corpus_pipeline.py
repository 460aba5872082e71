"""The corpus pipeline: documents that pass every stage, mixed to the target weights.

Each stage takes (spark, docs, sf_dir), works on all documents that its
predecessor kept, and returns a frame with their columns; the last adds what the
mix takes of each. Labels and benchmark come from `sf_dir`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardspark.llm import decontamination, mixing, near_dedup, suffix_dedup, toxicity
from cardspark.llm.shipping import ship
from cardspark.session import written

#: five-word Jaccard similarity of near copies; 85 is the threshold of op7 alone
NEAR_PERCENT = 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below one half."""
    ship(spark)
    return toxicity.clean(docs, toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies; of rows with equal id and text, one."""
    ship(spark)
    kept = near_dedup.near_dedup(docs, percent=NEAR_PERCENT).filter("kept").select(F.col("doc_id").alias("kept_id")).distinct()
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["kept_id"]), "left_semi").dropDuplicates(["doc_id", "text"])


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings that an earlier document has; a document of which nothing is left goes."""
    ship(spark)
    cut = suffix_dedup.suffix_dedup(docs, characters=True, rest=True).filter("n_removed = 0 OR n_removed < n_bytes")
    text = F.when(F.col("n_removed") == 0, F.col("kept").cast("string")).otherwise(F.decode("kept", "UTF-8"))
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    out = cut.select("doc_id", text.alias("text"), *[F.col("rest")[c].alias(c) for c in others])
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    ship(spark)
    return decontamination.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with the number of words it takes of each."""
    return mixing.mix(docs).filter("taken > 0")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_copies),
    ("suffix_dedup", cut_repeats),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
]

#: the first stage is a learned classifier, which SQL cannot express
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

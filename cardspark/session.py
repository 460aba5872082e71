"""Session defaults and the shared folder used for written intermediates."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, Observation, SparkSession


def local_session(cores: str | int = 8, memory: str = "12g", app: str = "cardspark") -> SparkSession:
    """Single-machine session for tests and benchmarks.

    On a cluster the submitter's own configuration applies; nothing in the
    library depends on the values set here.
    """
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cores) if str(cores).isdigit() else "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: `spark.checkpoint.dir` of the session.

    A machine-local temporary folder is used only when the session is local
    and names none.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    return _own_folder(spark.sparkContext.applicationId)


@cache
def _own_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"cardspark-{application}-")


def new_path(spark: SparkSession, label: str) -> str:
    """Fresh path under the shared folder."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def written_with_metrics(df: DataFrame, label: str, watch: Observation) -> tuple[DataFrame, dict]:
    """Like `written`, for a frame observed by `watch`; returns its metrics too."""
    out = written(df, label)
    return out, watch.get


def written(df: DataFrame, label: str) -> DataFrame:
    """Write `df` to the shared folder and read it back.

    Cuts the lineage so that a lost executor re-reads files instead of
    recomputing earlier rounds, and fixes the outcome of anything that would
    differ between two evaluations (sampling for a range sort, for example).
    """
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

"""Names and folders of the warehouse tables the daily jobs share."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from cardspark.sinks.tables import refresh_snapshot


@dataclass(frozen=True)
class Warehouse:
    """Tables `<schema>.<name>` stored below `root`, a folder all executors reach."""

    spark: SparkSession
    root: str
    schema: str = "default"

    def name(self, table: str) -> str:
        return f"{self.schema}.{table}"

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    def exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(self.name(table))

    def table(self, table: str) -> DataFrame:
        return self.spark.table(self.name(table))

    def table_or_none(self, table: str) -> DataFrame | None:
        return self.table(table) if self.exists(table) else None

    def replace(self, table: str, rows: DataFrame) -> DataFrame:
        """Write a new version beside the old one, then point the table at it."""
        refresh_snapshot(rows, self.name(table), self.path(table))
        return self.table(table)

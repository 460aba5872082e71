"""Periods and calendar buckets."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DAY_PARTS = ["nuit", "matin", "midi", "apres_midi", "soiree"]
MONTH_WEEKS = ["premiere_semaine", "deuxieme_semaine", "troisieme_semaine", "quatrieme_semaine"]
WEEK_PARTS = ["semaine", "week_end"]
BUCKETS = {"jour_moment": DAY_PARTS, "mois_moment": MONTH_WEEKS, "is_week_end": WEEK_PARTS}


def timestamp(value: dt.datetime | dt.date | str) -> Column:
    """Literal timestamp without zone."""
    return F.lit(str(value)).cast("timestamp_ntz")


@dataclass(frozen=True)
class Period:
    """Half-open interval `[start, end)`.

    `months("2024_1", "2024_3")` covers three whole calendar months; any other
    bound can be passed to the constructor.
    """

    start: dt.datetime
    end: dt.datetime

    @staticmethod
    def months(start_ym: str, end_ym: str) -> "Period":
        first_y, first_m = (int(p) for p in start_ym.split("_"))
        last_y, last_m = (int(p) for p in end_ym.split("_"))
        return Period(
            dt.datetime(first_y, first_m, 1),
            dt.datetime(last_y + last_m // 12, last_m % 12 + 1, 1),
        )

    @property
    def last_day(self) -> dt.datetime:
        """Midnight of the last day, the anchor of the look-back windows."""
        return dt.datetime.combine((self.end - dt.timedelta(microseconds=1)).date(), dt.time())

    def month_list(self) -> list[tuple[int, int]]:
        """Every (year, month) touched, without gaps."""
        last = self.last_day
        first = self.start.year * 12 + self.start.month - 1
        return [(n // 12, n % 12 + 1) for n in range(first, last.year * 12 + last.month)]

    def holds(self, ts: Column | str = "TransactionTime") -> Column:
        ts = F.col(ts) if isinstance(ts, str) else ts
        return (ts >= timestamp(self.start)) & (ts < timestamp(self.end))


def partitions(df: DataFrame, period: Period) -> Column:
    """Predicate on `year` and `month` when the table is partitioned by them.

    A predicate on the timestamp alone does not prune folders.
    """
    if not {"year", "month"} <= set(df.columns):
        return F.lit(True)
    months = period.month_list()
    index = F.col("year") * 12 + F.col("month")
    low, high = months[0], months[-1]
    return (
        F.col("year").between(low[0], high[0])
        & (index >= low[0] * 12 + low[1])
        & (index <= high[0] * 12 + high[1])
    )


def period(df: DataFrame, span: Period, ts: str = "TransactionTime") -> DataFrame:
    """Rows of a period, pruning month folders where the table has them."""
    return df.filter(partitions(df, span) & span.holds(ts))


def months_back(anchor: dt.datetime, n: int) -> dt.datetime:
    """First day of the month n months before `anchor`."""
    index = anchor.year * 12 + anchor.month - 1 - n
    return dt.datetime(index // 12, index % 12 + 1, 1)


def from_month(df: DataFrame, first: dt.datetime) -> DataFrame:
    """Rows of the month folders from that of `first` on; all rows where the table has no folders.

    For look-backs, which are open at the upper end: the predicate on the time
    stays with the caller.
    """
    if not {"year", "month"} <= set(df.columns):
        return df
    year, month = F.col("year"), F.col("month")
    return df.filter((year >= first.year) & ((year > first.year) | (month >= first.month)))


def one_day(day: dt.date | str) -> Period:
    start = dt.datetime.fromisoformat(str(day)[:10])
    return Period(start, start + dt.timedelta(days=1))


def calendar_buckets(df: DataFrame, ts: str = "TransactionTime") -> DataFrame:
    """Weekday name, day, hour and the three bucket columns."""
    hour, day = F.hour(ts), F.dayofmonth(ts)
    part = (
        F.when(hour < 5, "nuit").when(hour <= 11, "matin").when(hour <= 14, "midi")
        .when(hour <= 19, "apres_midi").when(hour <= 23, "soiree").otherwise("")
    )
    week = (
        F.when(day <= 7, MONTH_WEEKS[0]).when(day <= 14, MONTH_WEEKS[1])
        .when(day <= 21, MONTH_WEEKS[2]).when(day > 21, MONTH_WEEKS[3]).otherwise("")
    )
    weekend = F.when(F.dayofweek(ts).isin(1, 7), "week_end").otherwise("semaine")
    return df.withColumns({
        "jour_nom": F.date_format(ts, "EEEE"), "jour_num": day, "heure_num": hour,
        "jour_moment": part, "mois_moment": week, "is_week_end": weekend,
    })


def months_before(anchor: dt.datetime, n: int) -> Column:
    """`anchor` minus n months, clamped to the end of a shorter month."""
    return timestamp(anchor) - F.make_ym_interval(F.lit(0), F.lit(n))

"""Money, ratios and pattern columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

MONEY = DecimalType(18, 2)


def money(column: Column | str) -> Column:
    """Exact amount: a sum of decimals does not depend on the partitioning."""
    column = F.col(column) if isinstance(column, str) else column
    return column.cast(MONEY)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as a double, 0 when undefined."""
    return F.coalesce(
        F.try_divide(numerator.cast("double"), denominator.cast("double")), F.lit(0.0)
    )


def matches(column: Column | str, pattern: str) -> Column:
    """Case-insensitive search where `.` also matches a line end."""
    column = F.col(column) if isinstance(column, str) else column
    return column.rlike("(?isu)" + pattern)


# fixed values: POSIX character classes and the names Java gives them
POSIX_CLASSES = {
    "alpha": r"\p{Alpha}", "digit": r"\p{Digit}", "alnum": r"\p{Alnum}", "upper": r"\p{Upper}",
    "lower": r"\p{Lower}", "punct": r"\p{Punct}", "space": r"\s", "blank": r"\p{Blank}",
    "cntrl": r"\p{Cntrl}", "graph": r"\p{Graph}", "print": r"\p{Print}", "xdigit": r"\p{XDigit}",
}


def java_pattern(column: Column | str) -> Column:
    """Rewrite a PostgreSQL pattern column to the Java syntax `rlike` expects."""
    out = F.col(column) if isinstance(column, str) else column
    out = F.regexp_replace(out, r"(?<!\\)\\[mMy]", r"\\b")
    for name, java in POSIX_CLASSES.items():
        out = F.replace(out, F.lit(f"[:{name}:]"), F.lit(java))
    return F.concat(F.lit("(?isu)"), out)

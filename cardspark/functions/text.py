"""Cleaning of identity, contact and status attributes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def without_quotes(column: Column | str) -> Column:
    return F.replace(_col(column), F.lit("'"), F.lit(""))


def normalize_phone(column: Column | str) -> Column:
    """Drop a leading `00`, a trailing `.0` and every `|`."""
    out = F.regexp_replace(_col(column), "^00", "")
    out = F.regexp_replace(out, r"\.0$", "")
    return F.replace(out, F.lit("|"), F.lit(""))


# fixed values: KYC codes and their labels
KYC_LABELS = {"0": "Anonyme", "1": "SDD", "2": "KYC", "3": "KYC LITE"}


def kyc_label(column: Column | str) -> Column:
    """Label of a KYC code written `2`, `2.0` or as a number; others are kept."""
    text = _col(column).cast("string")
    out = text
    for code, label in KYC_LABELS.items():
        out = F.when(text.isin(code, f"{code}.0"), F.lit(label)).otherwise(out)
    return out


def expiry_date(column: Column | str) -> Column:
    """`YYMM` to the first day of that month in 20YY, null when malformed."""
    text = _col(column).cast("string")
    iso = F.concat(
        F.lit("20"), F.substring(text, 1, 2), F.lit("-"), F.substring(text, 3, 10), F.lit("-01")
    )
    return iso.try_cast("timestamp_ntz")


LONG_DATE = r"^([A-Za-z]{3}) (\d{1,2}) (\d{4}) (0?[1-9]|1[0-2]):(\d{2})([AaPp][Mm])$"


def long_date(column: Column | str) -> Column:
    """`Jan  5 2019 12:00AM` to a timestamp, null when malformed."""
    # put together without a zone: a time that a zone skips in spring stays what it is
    single = F.trim(F.regexp_replace(_col(column), " +", " "))
    part = [F.regexp_extract(single, LONG_DATE, i) for i in range(1, 7)]
    month = F.floor((F.instr(F.lit("JANFEBMARAPRMAYJUNJULAUGSEPOCTNOVDEC"), F.upper(part[0])) + 2) / 3)
    hour = F.pmod(part[3].try_cast("int"), F.lit(12)) + F.when(F.upper(part[5]) == "PM", 12).otherwise(0)
    two = [F.lpad(x.cast("string"), 2, "0") for x in (month, part[1], hour, part[4])]
    iso = F.concat(part[2], F.lit("-"), two[0], F.lit("-"), two[1], F.lit(" "), two[2], F.lit(":"), two[3], F.lit(":00"))
    good = F.rlike(single, F.lit(LONG_DATE)) & F.pmod(F.instr(
        F.lit("JANFEBMARAPRMAYJUNJULAUGSEPOCTNOVDEC"), F.upper(part[0])) - 1, F.lit(3)).eqNullSafe(0)
    return F.when(good, iso.try_cast("timestamp_ntz"))


def squeeze(column: Column | str) -> Column:
    """Lower case without spaces, null as an empty string."""
    return F.lower(F.replace(F.coalesce(_col(column), F.lit("")), F.lit(" "), F.lit("")))


def person_key(birth: Column | str = "BirthDate", last_name: Column | str = "LastName") -> Column:
    return F.concat_ws("", _col(birth).cast("string"), _col(last_name))


def address_key() -> Column:
    """Comparable address; the second line enters twice, as in the jobs replaced."""
    parts = ["Address1", "Address2", "PostCode", "Address2", "City"]
    return F.concat_ws("", *[squeeze(F.col(p).cast("string")) for p in parts])

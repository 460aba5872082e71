"""Cleaning of landing frames into warehouse rows."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardspark import schemas
from cardspark.functions.text import (
    expiry_date, kyc_label, long_date, normalize_phone, squeeze, without_quotes,
)
from cardspark.functions.values import matches

# Issuer data: the names below are invented and meant to be replaced by the caller.
PROGRAMS = {"CHROMERECON": "CHROME", "BLACKRECON": "BLACK", "INFINITYRECON": "INFINITY"}
PLACEHOLDER_ADDRESSES = ["1 EXAMPLE STREET", "ADDRESS", "PO BOX 1"]

# fixed values: distributors that only deliver renewals
RENEWAL_DISTRIBUTORS = [203, 914, 915]


@dataclass(frozen=True)
class IdentityRules:
    """Configured conditions of the identity jobs (defaults are invented)."""

    excluded_emails: str = r"@issuer\.example|@processor\.example"
    bad_email: str = r"^$|noreply|@none\."
    bad_last_name: str = r"^$|placeholder|unknown"
    bad_birth_dates: list[str] = field(default_factory=lambda: ["1988-08-08 00:00:00"])
    condition: str = "true"


def program_of(file_name: Column, programs: dict[str, str]) -> Column:
    """Card program from the first part of the file name, else the whole name."""
    prefix = F.split_part(file_name, F.lit("_"), F.lit(1))
    out = file_name
    for text, label in programs.items():
        out = F.when(prefix == text, F.lit(label)).otherwise(out)
    return out


def transaction_file_day(file_name: Column) -> Column:
    """Day in `<PROGRAM>_<DDMMYY>_<x>.csv`, null for any other name."""
    part = F.split(file_name, "_")
    stamp = F.try_element_at(part, F.lit(2))
    iso = F.concat(F.lit("20"), F.substring(stamp, 5, 2), F.lit("-"), F.substring(stamp, 3, 2),
                   F.lit("-"), F.substring(stamp, 1, 2))
    ok = (F.size(part) == 3) & (F.length(stamp) == 6)
    return F.when(ok, iso.try_cast("date"))


def clean_transactions(df: DataFrame, programs: dict[str, str] | None = None) -> DataFrame:
    """Landing rows to the 33-column raw transaction table.

    `df` holds text columns and `FileSource`, the name of the file of each row.
    Rows whose Date is not the day before the file day are dropped.
    """
    programs = PROGRAMS if programs is None else programs
    df = df.toDF(*[c.replace(" ", "") for c in df.columns])
    df = df.select(*[
        F.col(f"`{c}`") if c == "FileSource" or t != "string" else without_quotes(F.col(f"`{c}`")).alias(c)
        for c, t in df.dtypes
    ])
    df = df.filter(F.col("Date").try_cast("date") == F.date_sub(transaction_file_day(F.col("FileSource")), 1))
    df = df.withColumns({
        "TransactionTime": F.concat_ws(" ", "Date", "Time").try_cast("timestamp_ntz"),
        "CardType": program_of(F.col("FileSource"), programs),
    })
    typed = []
    for f in schemas.RAW_TRANSACTIONS.fields:
        value = F.col(f"`{f.name}`").cast(f.dataType)
        typed.append((F.abs(value) if f.name == "Amount" else value).alias(f.name))
    return df.select(*typed)


def clean_activations(df: DataFrame) -> DataFrame:
    """Activation rows; a malformed time fails the job."""
    return df.select(
        F.to_timestamp_ntz("ActivationTime", F.lit("dd/MM/yyyy HH:mm:ss")).alias("ActivationTime"),
        without_quotes("CardholderID").alias("CardHolderID"),
        "FileSource",
    )


def card_flags(df: DataFrame, addresses: list[str] | None = None) -> DataFrame:
    """Flags for placeholder addresses and renewal distributors."""
    addresses = PLACEHOLDER_ADDRESSES if addresses is None else addresses
    hit = F.col("Address1").isin(addresses) if addresses else F.lit(False)
    return df.withColumns({
        "IsExcludedAddress": F.coalesce(hit, F.lit(False)).cast("int"),
        "IsRenewal": F.coalesce(F.col("DistributorCode").isin(RENEWAL_DISTRIBUTORS), F.lit(False)).cast("int"),
    })


def clean_card_status(df: DataFrame, addresses: list[str] | None = None) -> DataFrame:
    """Card-status rows to the snapshot columns."""
    never = F.lit(None).cast("timestamp_ntz")
    out = df.select(
        F.col("CardHolderID").cast("string"), F.col("Card Status").cast("string").alias("CardStatus"),
        "City", "Country", "Email", "FirstName", "LastName", "IBAN", "Address1", "Address2", "PostCode",
        normalize_phone("NoMobile").alias("NoMobile"), "Programme", "ApplicationName",
        kyc_label("KYC Status").alias("KYC_Status"),
        F.col("AvailableBalance").try_cast("double").alias("AvailableBalance"),
        F.coalesce(F.col("DistributorCode").try_cast("double").cast("int"), F.lit(-1)).alias("DistributorCode"),
        long_date("Date of Birth").alias("BirthDate"), long_date("CreatedDate").alias("CreationDate"),
        long_date("UpdatedDate").alias("UpdateDate"), expiry_date("expirydate").alias("ExpirationDate"),
        *[never.alias(c) for c in
          ["ActivationDate", "RenewalDate", "LastChangeDate", "LastAddressDate", "LastCustomerDate"]],
    )
    return card_flags(out, addresses).select(*[f.name for f in schemas.CARD_SNAPSHOT.fields])


def clean_change_snapshot(df: DataFrame) -> DataFrame:
    """The 14 columns the change captures compare."""
    return df.select(
        F.col("CardHolderID").cast("string"), "Email", "FirstName", "LastName",
        long_date("Date of Birth").alias("BirthDate"), "IBAN",
        normalize_phone("NoMobile").alias("NoMobile"), "Programme", "Address1", "Address2", "PostCode",
        "City", kyc_label("KYC Status").alias("KYC_Status"),
        F.col("Card Status").cast("string").alias("CardStatus"),
    )


def normalize_identity(df: DataFrame) -> DataFrame:
    """Names, addresses, post code and e-mail in comparable form."""
    names = ["FirstName", "LastName", "Address1", "Address2", "PostCode", "Email"]
    return df.withColumns({c: squeeze(c) for c in names if c in df.columns})


def quality_flags(df: DataFrame, rules: IdentityRules = IdentityRules()) -> DataFrame:
    """GoodEmail and GoodCombinaison as 0/1."""
    birth = F.col("BirthDate").cast("string")
    bad_key = matches("LastName", rules.bad_last_name) | birth.isNull()
    if rules.bad_birth_dates:
        bad_key = bad_key | birth.isin(rules.bad_birth_dates)
    return df.withColumns({
        "GoodEmail": F.when(matches("Email", rules.bad_email), 0).otherwise(1),
        "GoodCombinaison": F.when(bad_key, 0).otherwise(1),
    })


def eligible_cards(df: DataFrame, rules: IdentityRules = IdentityRules()) -> DataFrame:
    """Cards that take part in identity: own phone, no issuer e-mail, configured condition."""
    return df.filter(
        F.expr(rules.condition)
        & F.col("NoMobile").isNotNull()
        & (F.col("CardHolderID") != "0")
        & ~matches(F.coalesce("Email", F.lit("")), rules.excluded_emails)
    )

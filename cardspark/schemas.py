"""Declared schemas of the files and warehouse tables."""

from __future__ import annotations

from pyspark.sql.types import (
    DoubleType, IntegerType, StringType, StructField, StructType, TimestampNTZType,
)


def struct(**types: list[str]) -> StructType:
    kinds = {"text": StringType(), "real": DoubleType(), "whole": IntegerType(), "time": TimestampNTZType()}
    fields = [StructField(n, kinds[k]) for k, names in types.items() for n in names]
    return StructType(sorted(fields, key=lambda f: f.name))


def all_text(names: list[str]) -> StructType:
    return StructType([StructField(n, StringType()) for n in names])


RAW_TRANSACTIONS = struct(
    real=["Amount", "Fee", "Rate", "RemainingBalance", "Surcharge"],
    whole=["DistributorCode"],
    time=["TransactionTime"],
    text=["AuthNum", "CardHolderID", "CardNumber", "CardProductName", "CardType", "CardVPUType",
          "Currency", "CurrencyCode", "DebitCredit", "Description", "FileSource", "LastName", "MCC",
          "MerchantAddress", "MerchantCity", "MerchantCountry", "MerchantID", "MerchantName",
          "ProgramName", "PurseCurrency", "SweepCurrency", "TermState", "TransactionDB/CR",
          "TransactionID", "TransactionResult", "TransactionTP"],
)

CARD_SNAPSHOT = struct(
    real=["AvailableBalance"],
    whole=["DistributorCode", "IsExcludedAddress", "IsRenewal"],
    time=["ActivationDate", "BirthDate", "CreationDate", "ExpirationDate", "LastChangeDate",
          "LastAddressDate", "LastCustomerDate", "RenewalDate", "UpdateDate"],
    text=["CardHolderID", "CardStatus", "City", "Country", "Email", "FirstName", "LastName", "IBAN",
          "Address1", "Address2", "PostCode", "NoMobile", "Programme", "ApplicationName", "KYC_Status"],
)

ACTIVATIONS = struct(time=["ActivationTime"], text=["CardHolderID", "FileSource"])

# fixed values: column order of the header-less card-status files
_STATUS_HEAD = ["CardHolderID", "Cardnumber", "Email", "FirstName", "LastName", "City", "Country",
                "Card Status", "DistributorCode", "ApplicationName", "Date of Birth",
                "SortCodeAccNum", "IBAN", "CreatedDate", "UpdatedDate", "Address1", "Address2",
                "PostCode", "KYC Status", "expirydate", "AvailableBalance"]
STATUS_LAYOUT_A = all_text(_STATUS_HEAD)
STATUS_LAYOUT_B = all_text(_STATUS_HEAD + ["UDF2", "NoMobile", "UDF3", "VPVR"])
STATUS_LAYOUT_C = all_text(_STATUS_HEAD + ["UDF2", "NoMobile", "Programme", "VPVR"])

ACTIVATION_FILE = all_text(["CardholderID", "ActivationTime"])

"""Split raw transactions into five families.

Each function serves the bulk build and, with `day`, the daily increment; the
day also prunes the month folder when the raw table is partitioned.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardspark.functions.dates import one_day, period

# fixed values: movement types
POS_TYPES = ["POS International", "POS Domestic"]
ATM_TYPES = ["ATM International", "ATM Domestic"]
LOAD_TYPES = ["Voucher load", "Terminal Load", "Sepa Incoming Payment", "Card to Card In",
              "INTERNET DEBIT/CREDIT"]
# fixed values: types that do not count as other movements
NOT_OTHER_TYPES = [
    "ATM Domestic", "ATM Domestic Fee", "ATM International", "ATM International Fee",
    "BalanceInquiry fee", "FX Fee", "Bank Payment fee", "Bank Transfer Fee", "Batch Load Fee",
    "Card Fee", "Card Load Fee", "Card Load at Payzone Fee", "Card To Card Transfer Fee",
    "Card to Card In", "Cash Advance Fee", "Decline Fee", "Deposit To Card API Fee",
    "INTERNET DEBIT/CREDIT", "IVR Fee", "InternetDrCrFee", "KYC Card Upgrade Fee", "Monthly Fee",
    "POS Domestic", "POS International", "POS International Fee", "Paytrail Load Fee",
    "Post Office Fee", "RefundFee", "Replacement Card Fee", "Replacement Card In",
    "SEPA Outgoing Payment Fee", "SMS Balance Inquiry fee", "SMS Fee", "SMS Lock UnLock Fee",
    "Sepa Credit Fee", "Sepa Incoming Payment", "Sepa Incoming Payment Fee", "Terminal Load",
    "Terminal load fee", "Upgrade to Physical Fee", "Voucher load", "Voucher load fee",
]

_PLACE = ["Currency", "CardVPUType", "MerchantAddress", "MerchantCity", "MerchantCountry",
          "MerchantID", "TransactionID"]


def _of_day(df: DataFrame, day: dt.date | str | None) -> DataFrame:
    return df if day is None else period(df, one_day(day))


def _has(text: str) -> Column:
    return F.lower("TransactionTP").contains(text)


def _approved(side: str) -> Column:
    return (F.col("DebitCredit") == side) & (F.col("TransactionResult") == "APPROVED")


def _international(label: str, name: str) -> Column:
    return F.when(F.col("TransactionTP") == label, 1).otherwise(0).alias(name)


def pos(df: DataFrame, day: dt.date | str | None = None) -> DataFrame:
    """Card payments, categories still empty."""
    return _of_day(df, day).filter(F.col("TransactionTP").isin(POS_TYPES) & _approved("Debit")).select(
        "CardHolderID", "MCC", "Amount", "MerchantName", "TransactionTime", *_PLACE,
        _international("POS International", "IsPOSInternational"), "TransactionTP",
        F.lit("").alias("UNIVERS"), F.lit("").alias("SOUS_UNIVERS"),
    )


def atm(df: DataFrame, day: dt.date | str | None = None) -> DataFrame:
    """Cash withdrawals."""
    return _of_day(df, day).filter(F.col("TransactionTP").isin(ATM_TYPES) & _approved("Debit")).select(
        "CardHolderID", "MCC", "Amount", "MerchantName", "TransactionTime", *_PLACE,
        _international("ATM International", "IsInternational"), "TransactionTP",
    )


def other(df: DataFrame, day: dt.date | str | None = None) -> DataFrame:
    """Every other movement, with reversal and fee flags."""
    keep = ~F.col("TransactionTP").isin(NOT_OTHER_TYPES) & ~_has("auth")
    return _of_day(df, day).filter(keep).select(
        "CardHolderID", "MCC", "Amount", "MerchantName", "TransactionTP", "TransactionTime", *_PLACE,
        "DebitCredit", _has("reversal").cast("int").alias("IsReversal"), _has("fee").cast("int").alias("IsFee"),
    )


def repaired_surcharge() -> Column:
    """FX fees are charged: a negative surcharge becomes positive."""
    wrong = (F.col("TransactionTP") == "FX Fee") & (F.col("Surcharge") < 0)
    return F.when(wrong, F.abs("Surcharge")).otherwise(F.col("Surcharge"))


def fees(df: DataFrame, day: dt.date | str | None = None) -> DataFrame:
    """Fees charged, with the FX repair applied."""
    return _of_day(df, day).filter(_approved("Debit") & _has("fee") & ~_has("reversal")).select(
        "CardHolderID", "MCC", "Fee", repaired_surcharge().alias("Surcharge"), "TransactionTP",
        "TransactionTime", *_PLACE,
    )


def loads(df: DataFrame, day: dt.date | str | None = None) -> DataFrame:
    """Money loaded onto the card."""
    return _of_day(df, day).filter(F.col("TransactionTP").isin(LOAD_TYPES) & _approved("Credit")).select(
        "CardHolderID", "MCC", "Amount", "TransactionTP", "TransactionTime", *_PLACE,
    )


FAMILIES = {"pos": pos, "atm": atm, "other": other, "fees": fees, "loads": loads}


def money_class(df: DataFrame) -> DataFrame:
    """Row predicates: fee debit, real debit, refunded fee, credit."""
    amount, fee = F.col("Amount"), F.col("Fee")
    debit, credit = F.col("DebitCredit") == "Debit", F.col("DebitCredit") == "Credit"
    return df.withColumns({
        "is_fee_debit": (amount >= 0) & debit & (fee > 0),
        "is_real_debit": (amount > 0) & debit & (fee == 0),
        "is_refunded_fee": (amount == 0) & credit,
        "is_credit": (amount > 0) & credit,
    })


def spending_other(df: DataFrame) -> DataFrame:
    """The other movements that count as spending."""
    return df.filter((F.col("DebitCredit") == "Debit") & (F.col("IsReversal") == 0) & (F.col("IsFee") == 0))

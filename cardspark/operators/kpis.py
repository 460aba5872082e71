"""Card behaviour indicators.

Every indicator of a card comes from one conditional aggregation over the union
of the families it needs: each family is read once, rows are combined on the map
side, and only one row per card and task crosses the network. The months in
which a card was active are counted with bit masks, so no second grouping by
month is needed.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardspark.functions.dates import Period, from_month, months_back, period
from cardspark.functions.values import ratio
from cardspark.operators.families import spending_other
from cardspark.operators.lookup import small

CARD = "CardHolderID"
WINDOWS = (3, 6, 12)
_MASK_BITS = 60

# last-time column per family, and the order in which ties are settled
LAST_TIME = {"atm": "dernier_retrait", "other": "dernier_other", "load": "dernier_chargement",
             "pos": "dernier_achat", "fees": "dernier_fees"}
# fixed values: groups of the type dimension and the name they get in the counters
TYPE_GROUPS = {"POS": "POS", "ATM": "ATM", "CCin": "Card to card in", "CCout": "Card to card out",
               "LOAD": "LOAD", "Rin": "Replacement in", "Rout": "Replacement out",
               "Vin": "Virement entrant", "Vout": "Virement sortant"}
INTERNATIONAL = {"atm": "IsInternational", "pos": "IsPOSInternational"}


def _movements(family: str, df: DataFrame) -> DataFrame:
    """A family in the common shape the aggregations read."""
    none = "CAST(NULL AS DECIMAL(18,2))"
    fee = family == "fees"
    counts = "DebitCredit = 'Debit' AND IsReversal = 0 AND IsFee = 0" if family == "other" else "true"
    return df.select(
        CARD, "TransactionTime", "TransactionTP",
        F.lit(family).alias("family"),
        F.expr(none if fee else "CAST(Amount AS DECIMAL(18,2))").alias("amount"),
        F.expr("CAST(Fee AS DECIMAL(18,2))" if fee else none).alias("fee"),
        F.expr("CAST(Surcharge AS DECIMAL(18,2))" if fee else none).alias("surcharge"),
        F.expr(f"CAST({INTERNATIONAL.get(family, '0')} AS INT)").alias("international"),
        F.expr(f"coalesce({counts}, false)").alias("counts"),
    )


def _union(families: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [_movements(f, d) for f, d in families.items()])


def _stamp(value: dt.datetime) -> str:
    return f"TIMESTAMP_NTZ '{value}'"


def _inside(span: Period) -> str:
    return f"TransactionTime >= {_stamp(span.start)} AND TransactionTime < {_stamp(span.end)}"


def _since(span: Period, months: int) -> str:
    """From n months before the last day of the period, clamped in a shorter month."""
    return f"TransactionTime >= {_stamp(span.last_day)} - INTERVAL '{months}' MONTH"


def _recent(df: DataFrame, span: Period, windows: tuple[int, ...]) -> DataFrame:
    """`df` from the month in which the longest look-back begins."""
    return from_month(df, months_back(span.last_day, max(windows)))


def _words(span: Period) -> int:
    return (len(span.month_list()) - 1) // _MASK_BITS + 1


def _flagged(moves: DataFrame, span: Period, families: list[str], windows: tuple[int, ...] = ()) -> DataFrame:
    """Evaluate every condition once per row, so that the aggregates only test flags.

    `in_<family>` marks the rows of a family that enter its indicators, `since_<n>`
    the look-back windows, `month_<w>` the bit of the month in mask word w.
    """
    columns = {f"in_{f}": F.expr(f"family = '{f}' AND counts AND amount >= 0 AND {_inside(span)}") for f in families}
    columns |= {f"since_{n}": F.expr(_since(span, n)) for n in windows}
    first = span.start.year * 12 + span.start.month
    for w in range(_words(span)):
        index = f"(year(TransactionTime) * 12 + month(TransactionTime) - {first + w * _MASK_BITS})"
        columns[f"month_{w}"] = F.expr(f"CASE WHEN {index} BETWEEN 0 AND {_MASK_BITS - 1} THEN shiftleft(1L, {index}) ELSE 0L END")
    return moves.withColumns(columns)


def _family_aggregates(family: str) -> list[Column]:
    parts = {"n": "count(1)", "s": "sum(amount)", "lo": "min(amount)", "hi": "max(amount)", "t": "max(TransactionTime)"}
    if family in INTERNATIONAL:
        parts["i"] = "sum(international)"
    return [F.expr(f"{agg} FILTER (WHERE in_{family})").alias(f"__{k}_{family}") for k, agg in parts.items()]


def _share(a: str, b: str) -> str:
    return f"coalesce(try_divide(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), 0D)"


def _family_columns(f: str, as_of: dt.datetime) -> list[Column]:
    out = {
        f"avg_daily_amount_{f}": _share(f"__s_{f}", f"__n_{f}"),
        f"frequency_{f}": f"__n_{f}",
        f"min_amount_{f}": f"CAST(__lo_{f} AS DOUBLE)",
        f"max_amount_{f}": f"CAST(__hi_{f} AS DOUBLE)",
        f"sum_amount_{f}": f"CAST(__s_{f} AS DOUBLE)",
        f"recence_{f}": f"timestampdiff(DAY, __t_{f}, {_stamp(as_of)})",
        LAST_TIME[f]: f"__t_{f}",
    }
    if f in INTERNATIONAL:
        out[f"international_frequency_{f}"] = f"__i_{f}"
        out[f"international_{f}_part"] = _share(f"__i_{f}", f"__n_{f}")
    return [F.expr(e).alias(n) for n, e in out.items()]


def _month_masks(family: str, span: Period) -> list[Column]:
    return [F.expr(f"bit_or(month_{w}) FILTER (WHERE in_{family})").alias(f"__m{w}_{family}") for w in range(_words(span))]


def _month_columns(f: str, span: Period) -> list[Column]:
    months = " + ".join(f"bit_count(coalesce(__m{w}_{f}, 0L))" for w in range(_words(span)))
    out = {
        f"num_month_{f}": f"CAST({months} AS BIGINT)",
        f"monthly_avg_amount_{f}": _share(f"__s_{f}", f"({months})"),
        f"monthly_average_frequency_{f}": _share(f"__n_{f}", f"({months})"),
    }
    return [F.expr(e).alias(n) for n, e in out.items()]


def _revenue_aggregates(span: Period) -> list[Column]:
    where = f"FILTER (WHERE family = 'fees' AND {_inside(span)})"
    return [
        F.expr(f"sum(fee) {where}").alias("__fee"),
        F.expr(f"sum(surcharge) {where}").alias("__surcharge"),
        F.expr(f"max(TransactionTime) {where}").alias("dernier_fees"),
    ]


def _revenue() -> Column:
    return F.expr("CAST(__fee + __surcharge AS DOUBLE)").alias("card_ca")


def _window_aggregates(windows: tuple[int, ...], name: str, families: list[str]) -> list[Column]:
    kinds = ", ".join(f"'{f}'" for f in families)
    where = f"family IN ({kinds}) AND counts AND amount >= 0"
    return [
        F.expr(f"CAST(sum(amount) FILTER (WHERE {where} AND since_{n}) AS DOUBLE)").alias(f"{name}_{n}_months")
        for n in windows
    ]


def _type_aggregates(windows: tuple[int, ...]) -> list[Column]:
    tests = {short: f"group_transactions = '{label}'" for short, label in TYPE_GROUPS.items()}
    tests["Volontaire"] = "IsVolontaire = 1"
    return [
        F.expr(f"count(amount) FILTER (WHERE {test} AND since_{n})").alias(f"Nb_Transaction_{short}_{n}_M")
        for n in windows for short, test in tests.items()
    ]


def _with_types(movements: DataFrame, types: DataFrame) -> DataFrame:
    types = types.groupBy("TransactionTP").agg(
        *[F.min(c).alias(c) for c in ("group_transactions", "IsVolontaire")])  # of repeated types, the least
    return movements.join(small(types), "TransactionTP", "left")


def family_kpis(df: DataFrame, family: str, span: Period, as_of: dt.datetime) -> DataFrame:
    """Amount, count, recency and international share of one family per card."""
    moves = _flagged(_movements(family, period(df, span)), span, [family]).filter(f"in_{family}")
    return moves.groupBy(CARD).agg(*_family_aggregates(family)).select(CARD, *_family_columns(family, as_of))


def family_monthly_kpis(df: DataFrame, family: str, span: Period) -> DataFrame:
    """Active months and the monthly means of amount and count per card."""
    moves = _flagged(_movements(family, period(df, span)), span, [family]).filter(f"in_{family}")
    return moves.groupBy(CARD).agg(*_family_aggregates(family)[:2], *_month_masks(family, span)).select(
        CARD, *_month_columns(family, span)
    )


def fee_kpis(fees: DataFrame, span: Period) -> DataFrame:
    """Revenue of a card and the time of its last fee."""
    moves = _movements("fees", period(fees, span))
    return moves.groupBy(CARD).agg(*_revenue_aggregates(span)).select(CARD, _revenue(), "dernier_fees")


def spend_mix(df: DataFrame) -> DataFrame:
    """Shares of withdrawals, payments and other movements in their sum."""
    parts = {f: F.coalesce(F.col(f"sum_amount_{f}"), F.lit(0.0)) for f in ("atm", "pos", "other")}
    total = parts["atm"] + parts["pos"] + parts["other"]
    return df.withColumns({f"{f}_part": ratio(c, total) for f, c in parts.items()})


def spend_last_months(
    pos: DataFrame, other: DataFrame, atm: DataFrame, span: Period, windows: tuple[int, ...] = WINDOWS
) -> DataFrame:
    """Spending since n months before the last day of the period, per card."""
    families = {"pos": pos, "other": spending_other(other), "atm": atm}
    families = {f: _recent(d, span, windows) for f, d in families.items()}
    recent = _union(families).filter(_since(span, max(windows))).filter("amount >= 0")
    return _flagged(recent, span, [], windows).groupBy(CARD).agg(
        *_window_aggregates(windows, "spendings", list(families))
    )


def loads_last_months(loads: DataFrame, span: Period, windows: tuple[int, ...] = WINDOWS) -> DataFrame:
    """Loads since n months before the last day of the period, per card."""
    recent = _movements("load", _recent(loads, span, windows)).filter(_since(span, max(windows))).filter("amount >= 0")
    return _flagged(recent, span, [], windows).groupBy(CARD).agg(*_window_aggregates(windows, "loads", ["load"]))


def type_counts(
    families: dict[str, DataFrame], types: DataFrame, span: Period, windows: tuple[int, ...] = WINDOWS
) -> DataFrame:
    """Movements per group of the type dimension and look-back window, per card."""
    families = {f: _recent(d, span, windows) for f, d in families.items()}
    recent = _union(families).filter(_since(span, max(windows)))
    flagged = _with_types(_flagged(recent, span, [], windows), types)
    return flagged.groupBy(CARD).agg(*_type_aggregates(windows))


def last_action(df: DataFrame) -> DataFrame:
    """Latest of the five last-times and the name of its column (first wins)."""
    names = list(LAST_TIME.values())
    latest = F.greatest(*names)
    which = F.lit("")
    for name in reversed(names):
        which = F.when(F.col(name) == latest, F.lit(name)).otherwise(which)
    return df.withColumns({"derniere_action": latest, "derniere_action_nom": which})


def attach(cards: DataFrame, *kpis: DataFrame) -> DataFrame:
    """Indicator sets on the full card list; numbers without a value become 0."""
    out = cards.select(CARD).distinct()
    for k in kpis:
        out = out.join(k, CARD, "left")
    numeric = [c for c, t in out.dtypes if t in ("int", "bigint", "double") or t.startswith("decimal")]
    return out.fillna(0, numeric)


def card_kpis(
    families: dict[str, DataFrame],
    cards: DataFrame,
    types: DataFrame,
    span: Period,
    as_of: dt.datetime,
    windows: tuple[int, ...] = WINDOWS,
) -> DataFrame:
    """The card behaviour table: all indicators of all cards, columns sorted.

    `families` maps pos, atm, other, load and fees to their tables.
    """
    kinds = ["atm", "load", "other", "pos"]
    first = min(span.start, months_back(span.last_day, max(windows)))
    families = {f: from_month(d, first) for f, d in families.items()}
    moves = _union(families).filter(f"({_inside(span)}) OR {_since(span, max(windows))}")
    flagged = _with_types(_flagged(moves, span, kinds, windows), types)
    wide = flagged.groupBy(CARD).agg(
        *[a for f in kinds for a in _family_aggregates(f)],
        *[m for f in kinds for m in _month_masks(f, span)],
        *_revenue_aggregates(span),
        *_window_aggregates(windows, "spendings", ["pos", "other", "atm"]),
        *_window_aggregates(windows, "loads", ["load"]),
        *_type_aggregates(windows),
    )
    passed = [c for c in wide.columns if c != CARD and not c.startswith("__")]
    table = wide.select(
        CARD,
        *[c for f in kinds for c in _family_columns(f, as_of)],
        *[c for f in kinds for c in _month_columns(f, span)],
        _revenue(),
        *passed,
    )
    out = last_action(spend_mix(attach(cards, table)))
    return out.select(*sorted(out.columns))

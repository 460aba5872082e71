"""Portable SQL for the queries, written independently of the operators."""

from __future__ import annotations

import re

from verification import fixtures as fx

_AS_OF = "TIMESTAMP '2024-02-15 06:00:00'"
_POS = "TransactionTP IN ('POS International', 'POS Domestic') AND DebitCredit = 'Debit' AND TransactionResult = 'APPROVED'"
_ATM = "TransactionTP IN ('ATM International', 'ATM Domestic') AND DebitCredit = 'Debit' AND TransactionResult = 'APPROVED'"
_PLACE = "Currency, CardVPUType, MerchantAddress, MerchantCity, MerchantCountry, MerchantID, TransactionID"
_EXCLUDED = [
    "ATM Domestic", "ATM Domestic Fee", "ATM International", "ATM International Fee", "BalanceInquiry fee", "FX Fee",
    "Bank Payment fee", "Bank Transfer Fee", "Batch Load Fee", "Card Fee", "Card Load Fee", "Card Load at Payzone Fee",
    "Card To Card Transfer Fee", "Card to Card In", "Cash Advance Fee", "Decline Fee", "Deposit To Card API Fee",
    "INTERNET DEBIT/CREDIT", "IVR Fee", "InternetDrCrFee", "KYC Card Upgrade Fee", "Monthly Fee", "POS Domestic",
    "POS International", "POS International Fee", "Paytrail Load Fee", "Post Office Fee", "RefundFee",
    "Replacement Card Fee", "Replacement Card In", "SEPA Outgoing Payment Fee", "SMS Balance Inquiry fee", "SMS Fee",
    "SMS Lock UnLock Fee", "Sepa Credit Fee", "Sepa Incoming Payment", "Sepa Incoming Payment Fee", "Terminal Load",
    "Terminal load fee", "Upgrade to Physical Fee", "Voucher load", "Voucher load fee",
]
_OTHER = f"TransactionTP NOT IN ({', '.join(repr(t) for t in _EXCLUDED)}) AND NOT regexp_matches(TransactionTP, 'auth', 'i')"
_FEES = ("DebitCredit = 'Debit' AND TransactionResult = 'APPROVED' AND regexp_matches(TransactionTP, 'fee', 'i') "
         "AND NOT regexp_matches(TransactionTP, 'reversal', 'i')")
_LOADS = ("DebitCredit = 'Credit' AND TransactionResult = 'APPROVED' AND TransactionTP IN ('Voucher load', "
          "'Terminal Load', 'Sepa Incoming Payment', 'Card to Card In', 'INTERNET DEBIT/CREDIT')")


def _family(kind: str, source: str) -> str:
    if kind == "pos":
        return (f"SELECT CardHolderID, MCC, Amount, MerchantName, TransactionTime, {_PLACE}, "
                "CASE WHEN TransactionTP = 'POS International' THEN 1 ELSE 0 END AS IsPOSInternational, TransactionTP, "
                f"'' AS UNIVERS, '' AS SOUS_UNIVERS FROM {source} WHERE {_POS}")
    if kind == "atm":
        return (f"SELECT CardHolderID, MCC, Amount, MerchantName, TransactionTime, {_PLACE}, "
                "CASE WHEN TransactionTP = 'ATM International' THEN 1 ELSE 0 END AS IsInternational, TransactionTP "
                f"FROM {source} WHERE {_ATM}")
    if kind == "other":
        return (f"SELECT CardHolderID, MCC, Amount, MerchantName, TransactionTP, TransactionTime, {_PLACE}, DebitCredit, "
                "CASE WHEN regexp_matches(TransactionTP, 'reversal', 'i') THEN 1 ELSE 0 END AS IsReversal, "
                f"CASE WHEN regexp_matches(TransactionTP, 'fee', 'i') THEN 1 ELSE 0 END AS IsFee FROM {source} WHERE {_OTHER}")
    if kind == "fees":
        return ("SELECT CardHolderID, MCC, Fee, CASE WHEN TransactionTP = 'FX Fee' AND Surcharge < 0 THEN abs(Surcharge) "
                f"ELSE Surcharge END AS Surcharge, TransactionTP, TransactionTime, {_PLACE} FROM {source} WHERE {_FEES}")
    return (f"SELECT CardHolderID, MCC, Amount, TransactionTP, TransactionTime, {_PLACE} FROM {source} WHERE {_LOADS}")


def _values(rows: list[tuple], names: list[str]) -> str:
    def one(v: object) -> str:
        if v is None:
            return "NULL"
        return "'" + str(v).replace("'", "''") + "'" if isinstance(v, str) else str(v)
    body = ", ".join("(" + ", ".join(one(v) for v in r) + ")" for r in rows)
    return f"SELECT * FROM (VALUES {body}) AS t({', '.join(names)})"


_SPEND = "DebitCredit = 'Debit' AND IsReversal = 0 AND IsFee = 0"

CTES: dict[str, str] = {
    "fx_tx": fx.portable(fx.FX_TX), "fx_long": fx.portable(fx.FX_TX_LONG), "fx_cards": fx.portable(fx.FX_CARDS),
    "fx_next": fx.portable(fx.FX_CARDS_NEXT), "fx_raw": fx.portable(fx.FX_RAW),
    "fx_status": fx.portable(fx.FX_STATUS_FILE),
    "types": _values(fx.TYPES, ["TransactionTP", "group_transactions", "IsVolontaire"]),
    "categories": _values(fx.CATEGORIES, ["UNIVERS_DATABASE", "SOUS_UNIVERS_DATABASE", "UNIVERS", "SOUS_UNIVERS"]),
    "mcc_link": _values(fx.MCC_LINK, ["MCC_CODE", "MCC"]),
    "mcc_categories": _values(fx.MCC_CATEGORIES, ["MCC_NAME", "SOUS_UNIVERS", "UNIVERS", "MCC_CODE", "NOTE"]),
    "override_rules": _values(fx.OVERRIDE, ["MCC", "UNIVERS", "SOUS_UNIVERS", "NEW_REGEX", "rule_order"]),
    "fill_rules": _values(fx.FILL, ["UNIVERS", "SOUS_UNIVERS", "NEW_REGEX", "rule_order"]),
}
for _k in ["pos", "atm", "other", "fees", "loads"]:
    CTES[f"{_k}_tx"] = _family(_k, "fx_tx")
    CTES[f"{_k}_long"] = _family(_k, "fx_long")


def with_views(body: str, extra: dict[str, str] | None = None, recursive: bool = False) -> str:
    """Prefix `body` with the views it mentions, in dependency order."""
    views = {**CTES, **(extra or {})}
    order: list[str] = []

    def need(text: str) -> None:
        for name in views:
            if name not in order and re.search(rf"\b{name}\b", text):
                if views[name] != text:
                    need(views[name])
                if name not in order:
                    order.append(name)

    need(body)
    if not order:
        return body
    head = "WITH RECURSIVE " if recursive else "WITH "
    return head + ",\n".join(f"{n} AS ({views[n]})" for n in order) + "\n" + body


ORACLES: dict[str, str] = {}
for _k in ["pos", "atm", "other", "fees", "loads"]:
    ORACLES[f"family_{_k}"] = with_views(f"SELECT * FROM {_k}_tx")
ORACLES["family_pos_day"] = with_views(
    "SELECT * FROM pos_tx WHERE TransactionTime >= '2024-01-10' AND TransactionTime < '2024-01-11'")
ORACLES["money_class"] = with_views("""
SELECT TransactionID, CAST(Amount >= 0 AND DebitCredit = 'Debit' AND Fee > 0 AS INT) AS is_fee_debit,
  CAST(Amount > 0 AND DebitCredit = 'Debit' AND Fee = 0 AS INT) AS is_real_debit,
  CAST(Amount = 0 AND DebitCredit = 'Credit' AS INT) AS is_refunded_fee,
  CAST(Amount > 0 AND DebitCredit = 'Credit' AS INT) AS is_credit FROM fx_tx""")
ORACLES["period_filter"] = with_views("""
SELECT TransactionID, CardHolderID, TransactionTime, CAST(Amount AS DOUBLE) AS Amount FROM fx_long
WHERE TransactionTime >= '1996-11-01' AND TransactionTime < '1997-03-01'""")

_LAST = {"atm": "dernier_retrait", "other": "dernier_other", "load": "dernier_chargement", "pos": "dernier_achat"}
_VIEW = {"atm": "atm_tx", "other": "other_tx", "load": "loads_tx", "pos": "pos_tx"}
_FLAG = {"atm": "IsInternational", "pos": "IsPOSInternational"}
_JAN = "TransactionTime >= '2024-01-01' AND TransactionTime < '2024-02-01'"


def _kpi(f: str) -> str:
    where = f"Amount >= 0 AND {_JAN}" + (f" AND {_SPEND}" if f == "other" else "")
    flag = ""
    if f in _FLAG:
        flag = (f", CAST(sum({_FLAG[f]}) AS BIGINT) AS international_frequency_{f}, "
                f"CAST(sum({_FLAG[f]}) AS DOUBLE) / count(*) AS international_{f}_part")
    return f"""SELECT CardHolderID, CAST(sum(Amount) AS DOUBLE) / count(*) AS avg_daily_amount_{f}, count(*) AS frequency_{f},
  CAST(min(Amount) AS DOUBLE) AS min_amount_{f}, CAST(max(Amount) AS DOUBLE) AS max_amount_{f},
  CAST(sum(Amount) AS DOUBLE) AS sum_amount_{f}, datesub('day', max(TransactionTime), {_AS_OF}) AS recence_{f},
  max(TransactionTime) AS {_LAST[f]}{flag} FROM {_VIEW[f]} WHERE {where} GROUP BY CardHolderID"""


def _monthly_kpi(f: str, view: str, where: str) -> str:
    return f"""SELECT CardHolderID, count(*) AS num_month_{f}, CAST(sum(s) AS DOUBLE) / count(*) AS monthly_avg_amount_{f},
  CAST(sum(n) AS DOUBLE) / count(*) AS monthly_average_frequency_{f}
FROM (SELECT CardHolderID, date_trunc('month', TransactionTime) AS m, sum(Amount) AS s, count(*) AS n FROM {view}
      WHERE {where} GROUP BY ALL) GROUP BY CardHolderID"""


for _f in ["atm", "pos", "other", "load"]:
    CTES[f"kpi_{_f}"] = _kpi(_f)
    _w = f"Amount >= 0 AND {_JAN}" + (f" AND {_SPEND}" if _f == "other" else "")
    CTES[f"monthly_{_f}"] = _monthly_kpi(_f, _VIEW[_f], _w)
    ORACLES["family_kpis_" + {"load": "loads"}.get(_f, _f)] = with_views(_kpi(_f))
ORACLES["family_monthly_kpis"] = with_views(_monthly_kpi(
    "pos", "pos_long", "Amount >= 0 AND TransactionTime >= '1995-01-01' AND TransactionTime < '2002-01-01'"))
CTES["kpi_fees"] = f"""SELECT CardHolderID, CAST(sum(Fee) + sum(Surcharge) AS DOUBLE) AS card_ca, max(TransactionTime) AS dernier_fees
FROM fees_tx WHERE {_JAN} GROUP BY CardHolderID"""
ORACLES["fee_kpis"] = with_views("SELECT * FROM kpi_fees")

_MIX = """coalesce({0} / nullif(sum_amount_atm + sum_amount_pos + sum_amount_other, 0), 0)"""
CTES["mix"] = """SELECT c.CardHolderID, coalesce(sum_amount_atm, 0) AS sum_amount_atm, coalesce(sum_amount_pos, 0) AS sum_amount_pos,
 coalesce(sum_amount_other, 0) AS sum_amount_other FROM fx_cards c LEFT JOIN kpi_atm USING (CardHolderID)
 LEFT JOIN kpi_pos USING (CardHolderID) LEFT JOIN kpi_other USING (CardHolderID)"""
ORACLES["spend_mix"] = with_views("SELECT *, " + ", ".join(
    _MIX.format(f"sum_amount_{f}") + f" AS {f}_part" for f in ["atm", "pos", "other"]) + " FROM mix")


def _spendings(suffix: str, anchor: str) -> str:
    cols = ", ".join(
        f"CAST(sum(Amount) FILTER (WHERE TransactionTime >= TIMESTAMP '{anchor}' - INTERVAL {n} MONTH) AS DOUBLE) AS spendings_{n}_months"
        for n in (3, 6, 12))
    return f"""SELECT CardHolderID, {cols} FROM (
 SELECT CardHolderID, TransactionTime, Amount FROM pos_{suffix} UNION ALL
 SELECT CardHolderID, TransactionTime, Amount FROM atm_{suffix} UNION ALL
 SELECT CardHolderID, TransactionTime, Amount FROM other_{suffix} WHERE {_SPEND})
WHERE Amount >= 0 AND TransactionTime >= TIMESTAMP '{anchor}' - INTERVAL 12 MONTH GROUP BY CardHolderID"""


ORACLES["spend_last_months"] = with_views(_spendings("long", "2001-03-31"))
CTES["spendings"] = _spendings("tx", "2024-01-31")
CTES["recent_loads"] = "SELECT CardHolderID, " + ", ".join(
    f"CAST(sum(Amount) FILTER (WHERE TransactionTime >= TIMESTAMP '2024-01-31' - INTERVAL {n} MONTH) AS DOUBLE) AS loads_{n}_months"
    for n in (3, 6, 12)) + (" FROM loads_tx WHERE Amount >= 0 AND TransactionTime >= TIMESTAMP '2024-01-31' - INTERVAL 12 MONTH "
                            "GROUP BY CardHolderID")
ORACLES["loads_last_months"] = with_views("SELECT * FROM recent_loads")
_GROUPS = {"POS": "POS", "ATM": "ATM", "CCin": "Card to card in", "CCout": "Card to card out", "LOAD": "LOAD",
           "Rin": "Replacement in", "Rout": "Replacement out", "Vin": "Virement entrant", "Vout": "Virement sortant"}
_COUNTERS = []
for _n in (3, 6, 12):
    _t = f"TransactionTime >= TIMESTAMP '2024-01-31' - INTERVAL {_n} MONTH"
    _COUNTERS += [f"count(Amount) FILTER (WHERE group_transactions = '{v}' AND {_t}) AS Nb_Transaction_{k}_{_n}_M"
                  for k, v in _GROUPS.items()]
    _COUNTERS.append(f"count(Amount) FILTER (WHERE IsVolontaire = 1 AND {_t}) AS Nb_Transaction_Volontaire_{_n}_M")
CTES["counters"] = f"""SELECT CardHolderID, {', '.join(_COUNTERS)} FROM (
 SELECT CardHolderID, TransactionTime, TransactionTP, Amount FROM pos_tx UNION ALL
 SELECT CardHolderID, TransactionTime, TransactionTP, Amount FROM atm_tx UNION ALL
 SELECT CardHolderID, TransactionTime, TransactionTP, Amount FROM other_tx UNION ALL
 SELECT CardHolderID, TransactionTime, TransactionTP, Amount FROM loads_tx) LEFT JOIN types USING (TransactionTP)
WHERE TransactionTime >= TIMESTAMP '2024-01-31' - INTERVAL 12 MONTH GROUP BY CardHolderID"""
ORACLES["type_counts"] = with_views("SELECT * FROM counters")

_TIMES = ["dernier_retrait", "dernier_other", "dernier_chargement", "dernier_achat", "dernier_fees"]
_LATEST = f"greatest({', '.join(_TIMES)})"
_NAME = "CASE " + " ".join(f"WHEN {t} = {_LATEST} THEN '{t}'" for t in _TIMES) + " ELSE '' END"
CTES["joined"] = """SELECT c.CardHolderID, kpi_atm.* EXCLUDE (CardHolderID), kpi_load.* EXCLUDE (CardHolderID),
 kpi_other.* EXCLUDE (CardHolderID), kpi_pos.* EXCLUDE (CardHolderID), kpi_fees.* EXCLUDE (CardHolderID),
 monthly_atm.* EXCLUDE (CardHolderID), monthly_load.* EXCLUDE (CardHolderID), monthly_other.* EXCLUDE (CardHolderID),
 monthly_pos.* EXCLUDE (CardHolderID), spendings.* EXCLUDE (CardHolderID), recent_loads.* EXCLUDE (CardHolderID),
 counters.* EXCLUDE (CardHolderID)
FROM fx_cards c LEFT JOIN kpi_atm ON c.CardHolderID = kpi_atm.CardHolderID
 LEFT JOIN kpi_load ON c.CardHolderID = kpi_load.CardHolderID LEFT JOIN kpi_other ON c.CardHolderID = kpi_other.CardHolderID
 LEFT JOIN kpi_pos ON c.CardHolderID = kpi_pos.CardHolderID LEFT JOIN kpi_fees ON c.CardHolderID = kpi_fees.CardHolderID
 LEFT JOIN monthly_atm ON c.CardHolderID = monthly_atm.CardHolderID
 LEFT JOIN monthly_load ON c.CardHolderID = monthly_load.CardHolderID
 LEFT JOIN monthly_other ON c.CardHolderID = monthly_other.CardHolderID
 LEFT JOIN monthly_pos ON c.CardHolderID = monthly_pos.CardHolderID
 LEFT JOIN spendings ON c.CardHolderID = spendings.CardHolderID
 LEFT JOIN recent_loads ON c.CardHolderID = recent_loads.CardHolderID
 LEFT JOIN counters ON c.CardHolderID = counters.CardHolderID"""
_ZERO = []
for _f in ["atm", "load", "other", "pos"]:
    _ZERO += [f"{p}_{_f}" for p in ["avg_daily_amount", "frequency", "min_amount", "max_amount", "sum_amount", "recence",
                                    "num_month", "monthly_avg_amount", "monthly_average_frequency"]]
for _f in ["atm", "pos"]:
    _ZERO += [f"international_frequency_{_f}", f"international_{_f}_part"]
_ZERO += ["card_ca"] + [f"{p}_{n}_months" for p in ("spendings", "loads") for n in (3, 6, 12)]
_ZERO += [f"Nb_Transaction_{k}_{n}_M" for k in [*_GROUPS, "Volontaire"] for n in (3, 6, 12)]
CTES["zeroed"] = ("SELECT CardHolderID, " + ", ".join(_TIMES) + ", "
                  + ", ".join(f"coalesce({c}, 0) AS {c}" for c in _ZERO) + " FROM joined")
ORACLES["card_kpis"] = with_views("SELECT *, " + ", ".join(
    _MIX.format(f"sum_amount_{f}") + f" AS {f}_part" for f in ["atm", "pos", "other"])
    + f", {_LATEST} AS derniere_action, {_NAME} AS derniere_action_nom FROM zeroed")
ORACLES["last_action"] = with_views(
    f"SELECT CardHolderID, {', '.join(_TIMES)}, {_LATEST} AS derniere_action, {_NAME} AS derniere_action_nom FROM joined")

# --- months
_PART = """CASE WHEN hour(TransactionTime) BETWEEN 0 AND 4 THEN 'nuit' WHEN hour(TransactionTime) BETWEEN 5 AND 11 THEN 'matin'
 WHEN hour(TransactionTime) BETWEEN 12 AND 14 THEN 'midi' WHEN hour(TransactionTime) BETWEEN 15 AND 19 THEN 'apres_midi' ELSE 'soiree' END"""
_WEEK = """CASE WHEN day(TransactionTime) BETWEEN 1 AND 7 THEN 'premiere_semaine' WHEN day(TransactionTime) BETWEEN 8 AND 14 THEN 'deuxieme_semaine'
 WHEN day(TransactionTime) BETWEEN 15 AND 21 THEN 'troisieme_semaine' ELSE 'quatrieme_semaine' END"""
_END = "CASE WHEN isodow(TransactionTime) >= 6 THEN 'week_end' ELSE 'semaine' END"
ORACLES["calendar_buckets"] = with_views(f"""SELECT TransactionID, TransactionTime, dayname(TransactionTime) AS jour_nom,
 CAST(day(TransactionTime) AS INT) AS jour_num, CAST(hour(TransactionTime) AS INT) AS heure_num,
 {_PART} AS jour_moment, {_WEEK} AS mois_moment, {_END} AS is_week_end FROM fx_tx""")
_BUCKETS = {"jour_moment": ["nuit", "matin", "midi", "apres_midi", "soiree"],
            "mois_moment": ["premiere_semaine", "deuxieme_semaine", "troisieme_semaine", "quatrieme_semaine"],
            "is_week_end": ["semaine", "week_end"]}


def _bucketed(view: str) -> str:
    return (f"SELECT *, {_PART} AS jour_moment, {_WEEK} AS mois_moment, {_END} AS is_week_end, "
            "Amount > 0 AND DebitCredit = 'Debit' AND Fee = 0 AS d, Amount > 0 AND DebitCredit = 'Credit' AS c, "
            f"date_trunc('month', TransactionTime) AS mth FROM {view} WHERE CardHolderID <> '0'")


CTES["b_tx"], CTES["b_long"] = _bucketed("fx_tx"), _bucketed("fx_long")


def _q(a: str, b: str) -> str:
    return f"coalesce(CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0), 0)"


_L = "coalesce(sum(Amount) FILTER (WHERE c), 0)"
_D = "coalesce(sum(Amount) FILTER (WHERE d), 0)"
_FLOWS = (f"{_q(_D, _L + ' + ' + _D)} AS part_debit_credit, "
          + _q("coalesce(sum(Amount) FILTER (WHERE c AND mois_moment = 'premiere_semaine'), 0)", _L) + " AS part_credit_begin, "
          + _q("coalesce(sum(Amount) FILTER (WHERE d AND mois_moment = 'quatrieme_semaine'), 0)", _D) + " AS part_debit_end")
_COUNTS = ", ".join(f"count(*) FILTER (WHERE d AND {b} = '{v}') AS frequence_debit_{b}_{v}"
                    for b, vs in _BUCKETS.items() for v in vs)
_COUNT_NAMES = [f"frequence_debit_{b}_{v}" for b, vs in _BUCKETS.items() for v in vs]
ORACLES["month_features"] = with_views(f"SELECT CardHolderID, {_FLOWS} FROM b_tx GROUP BY CardHolderID")
ORACLES["debit_buckets"] = with_views(f"SELECT CardHolderID, {_COUNTS} FROM b_tx GROUP BY CardHolderID")


def _balance(view: str, keys: str) -> str:
    return f"""SELECT {keys}, CAST(sum(RemainingBalance) AS DOUBLE) / count(RemainingBalance) AS remaining_balance_end_month
FROM (SELECT *, rank() OVER (PARTITION BY {keys} ORDER BY TransactionTime DESC) AS r FROM {view}) WHERE r = 1 GROUP BY {keys}"""


CTES["bal_tx"] = _balance("b_tx", "CardHolderID")
CTES["bal_long"] = _balance("b_long", "CardHolderID, mth")
ORACLES["end_balance"] = with_views(_balance("b_long", "CardHolderID"))
ORACLES["latest_rows"] = with_views("""SELECT CardHolderID, TransactionTime, TransactionID, CAST(Amount AS DOUBLE) AS Amount
FROM fx_long QUALIFY rank() OVER (PARTITION BY CardHolderID ORDER BY TransactionTime DESC) = 1""")
ORACLES["monthly_kpis"] = with_views(f"""SELECT * FROM (SELECT CardHolderID, {_FLOWS}, {_COUNTS} FROM b_tx GROUP BY CardHolderID)
JOIN bal_tx USING (CardHolderID)""")
_SUMMED = ["part_debit_credit", "part_credit_begin", "part_debit_end", "remaining_balance_end_month"]
CTES["months_long"] = f"""SELECT * FROM (SELECT CardHolderID, mth, {_FLOWS}, {_COUNTS} FROM b_long GROUP BY CardHolderID, mth)
JOIN bal_long USING (CardHolderID, mth)"""
CTES["rollup"] = ("SELECT CardHolderID, " + ", ".join(f"sum({c}) AS {c}" for c in _SUMMED) + ", "
                  + ", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in _COUNT_NAMES)
                  + ", count(*) AS num_events FROM months_long GROUP BY CardHolderID")
ORACLES["rollup_months"] = with_views(
    "SELECT CardHolderID, " + ", ".join(f"round({c}, 6) AS {c}" for c in _SUMMED) + ", " + ", ".join(_COUNT_NAMES)
    + ", num_events FROM rollup")
_SHARES = []
for _b, _total in [("mois_moment", "sum_frequency_mois_moment"), ("jour_moment", "sum_frequency_debit_jour"),
                   ("is_week_end", "sum_frequency_is_week_end")]:
    _sum = "(" + " + ".join(f"frequence_debit_{_b}_{v}" for v in _BUCKETS[_b]) + ")"
    _SHARES += [f"round({_q(f'frequence_debit_{_b}_{v}', _sum)}, 6) AS frequence_debit_{_b}_{v}" for v in _BUCKETS[_b]]
    _SHARES.append(f"{_sum} AS {_total}")
_SHARES += [f"round({c} / num_events, 6) AS avg_{c}" for c in _SUMMED]
ORACLES["normalize_rollup"] = with_views(f"SELECT CardHolderID, {', '.join(_SHARES)} FROM rollup")
ORACLES["align_tables"] = with_views(
    "SELECT CardHolderID, " + ", ".join(f"CAST(coalesce(a.{c}, 0) + coalesce(b.{c}, 0) AS BIGINT) AS {c}" for c in _COUNT_NAMES)
    + f" FROM (SELECT CardHolderID, {_COUNTS} FROM b_tx GROUP BY CardHolderID) a FULL JOIN "
    f"(SELECT CardHolderID, {_COUNTS} FROM b_long GROUP BY CardHolderID) b USING (CardHolderID)")

# --- age and usage
ORACLES["weighted_age"] = with_views(f"""
SELECT CardHolderID, round(sum(CAST(s AS DOUBLE) / CAST(total AS DOUBLE) * (y - birth)), 6) AS age_pondere FROM (
 SELECT m.CardHolderID, year(TransactionTime) AS y, sum(Amount) AS s, any_value(year(BirthDate)) AS birth,
   sum(sum(Amount)) OVER (PARTITION BY m.CardHolderID) AS total
 FROM (SELECT CardHolderID, TransactionTime, Amount FROM pos_long UNION ALL
       SELECT CardHolderID, TransactionTime, Amount FROM atm_long UNION ALL
       SELECT CardHolderID, TransactionTime, Amount FROM other_long WHERE {_SPEND}) m
 JOIN fx_cards c ON c.CardHolderID = m.CardHolderID
 WHERE Amount > 0 AND KYC_Status IN ('KYC', 'KYC LITE') AND BirthDate > TIMESTAMP '1940-01-01'
   AND BirthDate NOT IN (TIMESTAMP '1988-08-08', TIMESTAMP '1989-09-09', TIMESTAMP '1992-02-02', TIMESTAMP '1930-06-11')
 GROUP BY m.CardHolderID, year(TransactionTime)) GROUP BY CardHolderID""")
_MCC = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


def _matrix(cell: str, where: str) -> str:
    cols = ", ".join(cell.format(v) + f" AS {v}" for v in _MCC)
    return f"SELECT CardHolderID, {cols} FROM pos_long WHERE Amount > 0 AND MCC <> '' AND {where} GROUP BY CardHolderID"


_SPAN = "TransactionTime >= '1995-01-01' AND TransactionTime < '2002-01-01'"
CTES["usage_matrix"] = _matrix("CAST(coalesce(sum(Amount) FILTER (WHERE MCC = '{0}'), 0) AS DOUBLE)", _SPAN)
_TOTAL = "(" + " + ".join(_MCC) + ")"
CTES["usage_shares"] = "SELECT CardHolderID, " + ", ".join(f"{_q(m, _TOTAL)} AS {m}_Prop" for m in _MCC) + " FROM usage_matrix"
ORACLES["usage_amount"] = with_views("SELECT * FROM usage_matrix")
ORACLES["usage_frequency"] = with_views(_matrix(
    "count(*) FILTER (WHERE MCC = '{0}')", "TransactionTime >= '1998-01-01' AND TransactionTime < '1999-07-01'"))
ORACLES["usage_cells"] = with_views(f"""SELECT CardHolderID, MerchantID AS category, CAST(cell AS DOUBLE) AS cell,
 CAST(total AS DOUBLE) AS total, CAST(cell AS DOUBLE) / CAST(total AS DOUBLE) AS share FROM (
  SELECT CardHolderID, MerchantID, sum(Amount) AS cell, sum(sum(Amount)) OVER (PARTITION BY CardHolderID) AS total
  FROM pos_long WHERE Amount > 0 AND MerchantID <> '' AND {_SPAN} GROUP BY CardHolderID, MerchantID)""")
ORACLES["usage_share"] = with_views("SELECT * FROM usage_shares")
_TOP = "greatest(" + ", ".join(f"{m}_Prop" for m in _MCC) + ")"
ORACLES["usage_summary"] = with_views(
    f"SELECT *, {_TOP} AS max_usage_MCC, CASE " + " ".join(f"WHEN {m}_Prop = {_TOP} THEN '{m}'" for m in _MCC)
    + " END AS MCC_most_used, CAST(" + " + ".join(f"CAST({m}_Prop > 0 AS INT)" for m in _MCC) + " AS INT) AS num_MCC FROM usage_shares")

# --- categories
_JAVA = "replace(replace(NEW_REGEX, '\\m', '\\b'), '\\M', '\\b')"
for _pass, _notes in [("1", "(1)"), ("2", "(0, 2)")]:
    CTES[f"code_map{_pass}"] = f"""SELECT l.MCC, min(UNIVERS_DATABASE) AS u, min(SOUS_UNIVERS_DATABASE) AS s FROM mcc_categories m
 JOIN mcc_link l USING (MCC_CODE) JOIN categories USING (UNIVERS, SOUS_UNIVERS) WHERE NOTE IN {_notes} GROUP BY l.MCC"""
    CTES[f"override_map{_pass}"] = f"""SELECT l.MCC, {_JAVA} AS p, rule_order AS o, UNIVERS_DATABASE AS u, SOUS_UNIVERS_DATABASE AS s
 FROM override_rules r JOIN mcc_categories m ON r.MCC = m.MCC_NAME JOIN mcc_link l ON l.MCC_CODE = m.MCC_CODE
 JOIN categories k ON r.UNIVERS = k.UNIVERS AND r.SOUS_UNIVERS = k.SOUS_UNIVERS WHERE m.NOTE IN {_notes}"""
    CTES[f"override_hit{_pass}"] = f"""SELECT d.MCC, d.MerchantName, arg_max(u, o) AS u, arg_max(s, o) AS s
 FROM (SELECT DISTINCT MCC, MerchantName FROM pos_long) d
 JOIN override_map{_pass} r ON r.MCC = d.MCC AND regexp_matches(d.MerchantName, r.p, 'is') GROUP BY ALL"""
CTES["fill_hit"] = f"""SELECT d.MerchantName, arg_min(UNIVERS_DATABASE, rule_order) AS u, arg_min(SOUS_UNIVERS_DATABASE, rule_order) AS s
 FROM (SELECT DISTINCT MerchantName FROM pos_long) d JOIN fill_rules r ON regexp_matches(d.MerchantName, {_JAVA}, 'is')
 JOIN categories k ON r.UNIVERS = k.UNIVERS AND r.SOUS_UNIVERS = k.SOUS_UNIVERS GROUP BY ALL"""
_CAT = "TransactionID, CardHolderID, TransactionTime, t.MCC, t.MerchantName"


def _categorised(u: str, s: str) -> str:
    return f"""SELECT {_CAT}, {u} AS UNIVERS, {s} AS SOUS_UNIVERS FROM pos_long t
 LEFT JOIN code_map1 c1 ON c1.MCC = t.MCC LEFT JOIN code_map2 c2 ON c2.MCC = t.MCC
 LEFT JOIN override_hit1 o1 ON o1.MCC = t.MCC AND o1.MerchantName = t.MerchantName
 LEFT JOIN override_hit2 o2 ON o2.MCC = t.MCC AND o2.MerchantName = t.MerchantName
 LEFT JOIN fill_hit f ON f.MerchantName = t.MerchantName"""


ORACLES["categorize_mcc"] = with_views(_categorised("coalesce(c1.u, '')", "coalesce(c1.s, '')"))
ORACLES["categorize_override"] = with_views(_categorised("coalesce(o1.u, '')", "coalesce(o1.s, '')"))
ORACLES["categorize_fill"] = with_views(_categorised("coalesce(f.u, '')", "coalesce(f.s, '')"))
_ALL = ["coalesce(o2.{0}, c2.{0}, o1.{0}, c1.{0}, f.{0}, '')".format(x) for x in "us"]
ORACLES["categorize"] = with_views(_categorised(*_ALL))
CTES["categorised"] = _categorised(*_ALL)
ORACLES["usage_of_categories"] = with_views("SELECT CardHolderID, " + ", ".join(
    f"count(*) FILTER (WHERE UNIVERS = '{u}') AS {u}" for u in ["FOOD", "HOME", "LEISURE", "OTHER", "TRAVEL"])
    + " FROM (SELECT g.*, Amount FROM (SELECT *, row_number() OVER () AS rn FROM categorised) g "
    "JOIN (SELECT 1 AS Amount) ON true) WHERE UNIVERS <> '' GROUP BY CardHolderID")

# --- snapshots
_NEXT = "TIMESTAMP '2024-03-01 00:00:00' AS dt_change"
CTES["status_log"] = f"""SELECT o.CardHolderID, o.CardStatus, o.KYC_Status, {_NEXT} FROM fx_cards o JOIN fx_next n USING (CardHolderID)
WHERE o.CardStatus IS DISTINCT FROM n.CardStatus OR o.KYC_Status IS DISTINCT FROM n.KYC_Status"""
ORACLES["status_changes"] = with_views("SELECT * FROM status_log")
_WATCHED = ["Email", "FirstName", "LastName", "BirthDate", "IBAN", "NoMobile", "Programme"]


def _cmp(side: str, c: str) -> str:
    t = f"coalesce(CAST({side}.{c} AS VARCHAR), '')"
    return f"replace({t}, ' ', '')" if c in ("FirstName", "LastName") else t


_FLAGS = [f"CAST({_cmp('o', c)} <> {_cmp('n', c)} AS INT) AS Is_ch_{c}" for c in _WATCHED]
CTES["customer_log"] = ("SELECT *, " + " + ".join(f"Is_ch_{c}" for c in _WATCHED) + f" AS total_ch, {_NEXT} FROM (SELECT o.CardHolderID, "
                        + ", ".join(f"o.{c}" for c in _WATCHED) + ", " + ", ".join(_FLAGS)
                        + " FROM fx_cards o JOIN fx_next n USING (CardHolderID)) WHERE total_ch > 0")
ORACLES["customer_changes"] = with_views("SELECT * FROM customer_log")
_ADDR = ["Address1", "Address2", "PostCode", "City"]


def _key(side: str) -> str:
    return " || ".join(f"lower(replace(coalesce({side}.{c}, ''), ' ', ''))" for c in ["Address1", "Address2", "PostCode", "Address2", "City"])


ORACLES["address_changes"] = with_views(
    "SELECT o.CardHolderID, " + ", ".join(f"o.{c}" for c in _ADDR) + f", {_NEXT} FROM fx_cards o JOIN fx_next n USING (CardHolderID) "
    f"WHERE {_key('o')} <> {_key('n')} UNION ALL SELECT CardHolderID, " + ", ".join(_ADDR)
    + f", {_NEXT} FROM fx_next WHERE CardHolderID NOT IN (SELECT CardHolderID FROM fx_cards)")
ORACLES["last_change"] = with_views("""SELECT c.CardHolderID, max(l.dt_change) AS LastChangeDate FROM fx_cards c LEFT JOIN (
 SELECT CardHolderID, dt_change FROM status_log UNION ALL SELECT CardHolderID, dt_change + INTERVAL 7 DAY FROM customer_log) l
 ON l.CardHolderID = c.CardHolderID GROUP BY c.CardHolderID""")
ORACLES["fill_activation"] = with_views("""SELECT c.CardHolderID, coalesce(ActivationDate, t) AS ActivationDate FROM fx_cards c
 LEFT JOIN (SELECT CardHolderID, min(TransactionTime) AS t FROM fx_long GROUP BY CardHolderID) a ON a.CardHolderID = c.CardHolderID""")
ORACLES["clean_transactions"] = with_views("""
SELECT replace(TransactionID, '''', '') AS TransactionID, CardHolderID,
  CASE WHEN Time <> 'no time' THEN CAST(Date || ' ' || Time AS TIMESTAMP) END AS TransactionTime,
  abs(CAST(Amount AS DOUBLE)) AS Amount,
  CASE f1 WHEN 'CHROMERECON_' THEN 'CHROME' WHEN 'BLACKRECON_' THEN 'BLACK' WHEN 'INFINITYRECON_' THEN 'INFINITY'
    ELSE f1 || f2 || f3 END AS CardType,
  f1 || f2 || f3 AS FileSource, Description, CAST(DistributorCode AS INT) AS DistributorCode
FROM fx_raw WHERE f3 = '_1.csv'
  AND CAST(Date AS DATE) = CAST('20' || substr(f2, 5, 2) || '-' || substr(f2, 3, 2) || '-' || substr(f2, 1, 2) AS DATE) - 1""")
ORACLES["clean_activations"] = with_views("""SELECT date_trunc('second', TransactionTime) AS ActivationTime, CardHolderID,
 'a_20240101.csv' AS FileSource FROM fx_tx""")
_PHONE = "replace(regexp_replace(regexp_replace(NoMobile, '^00', ''), '\\.0$', ''), '|', '')"
_KYC = """CASE WHEN "KYC Status" IN ('0', '0.0') THEN 'Anonyme' WHEN "KYC Status" IN ('1', '1.0') THEN 'SDD'
 WHEN "KYC Status" IN ('2', '2.0') THEN 'KYC' WHEN "KYC Status" IN ('3', '3.0') THEN 'KYC LITE' ELSE "KYC Status" END"""


def _when(c: str) -> str:
    return f"try_strptime(regexp_replace({c}, ' +', ' ', 'g'), '%b %d %Y %I:%M%p')"


_BIRTH = _when('"Date of Birth"')
ORACLES["clean_card_status"] = with_views(f"""
SELECT CardHolderID, "Card Status" AS CardStatus, Email, {_PHONE} AS NoMobile, {_KYC} AS KYC_Status,
  CAST(AvailableBalance AS DOUBLE) AS AvailableBalance,
  coalesce(CAST(CAST(DistributorCode AS DOUBLE) AS INT), -1) AS DistributorCode,
  {_BIRTH} AS BirthDate, {_when('CreatedDate')} AS CreationDate, {_when('UpdatedDate')} AS UpdateDate,
  try_strptime('20' || substr(expirydate, 1, 2) || '-' || substr(expirydate, 3) || '-01', '%Y-%m-%d') AS ExpirationDate,
  CAST(Address1 = 'ADDRESS' AS INT) AS IsExcludedAddress,
  CAST(coalesce(DistributorCode IN ('203', '914.0', '915'), false) AS INT) AS IsRenewal FROM fx_status""")
ORACLES["clean_change_snapshot"] = with_views(f"""
SELECT CardHolderID, Email, FirstName, LastName, {_BIRTH} AS BirthDate, IBAN, {_PHONE} AS NoMobile, Programme, Address1, Address2,
  PostCode, City, {_KYC} AS KYC_Status, "Card Status" AS CardStatus FROM fx_status""")
ORACLES["text_keys"] = with_views(f"""SELECT CardHolderID, CAST(BirthDate AS VARCHAR) || LastName AS person, {_key('fx_next')} AS address,
 NoMobile AS phone FROM fx_next""")

# --- identity
_BASE = ["FirstName", "LastName", "Address1", "Address2", "PostCode", "Email"]
ORACLES["identity_base"] = with_views(
    "SELECT *, CASE WHEN regexp_matches(Email, 'u[0-9]*7@') THEN 0 ELSE 1 END AS GoodEmail, "
    "CASE WHEN regexp_matches(LastName, 'n1.*3$') OR BirthDate IN ('1960-06-15 00:00:00', '1970-06-15 00:00:00') THEN 0 ELSE 1 END AS GoodCombinaison "
    "FROM (SELECT CardHolderID, NoMobile, CAST(BirthDate AS VARCHAR) AS BirthDate, ActivationDate, "
    + ", ".join(f"lower(replace({c}, ' ', '')) AS {c}" for c in _BASE)
    + " FROM fx_cards WHERE CardHolderID <> '0' AND CardStatus <> 'MACHINERY' AND NOT regexp_matches(Email, 'u1[0-9]0@', 'i'))")
ORACLES["cards_per_phone"] = with_views("SELECT NoMobile, count(*) AS NUM_CARTES FROM fx_cards GROUP BY NoMobile")
CTES["base"] = """SELECT *, CAST(BirthDate AS VARCHAR) || LastName AS combinaison,
 CAST(CardHolderID AS BIGINT) % 7 < 4 AS early FROM fx_cards"""


def _numbered(key: str, name: str, where: str, extra: str = "") -> str:
    """First-day keys numbered first, then the new ones."""
    return f"""SELECT row_number() OVER (ORDER BY day, k) AS {name}, k AS {key}{', n AS NUM_CARTES' if extra else ''} FROM (
 SELECT {key} AS k, CASE WHEN bool_or(early) THEN 1 ELSE 2 END AS day,
   CASE WHEN bool_or(early) THEN count(*) FILTER (WHERE early) ELSE count(*) END AS n FROM base WHERE {where} GROUP BY {key})"""


CTES["phones"] = _numbered("NoMobile", "MOBILE_ID", "true", "n")
CTES["persons"] = _numbered("combinaison", "PERSON_ID", "GoodCombinaison = 1")
ORACLES["phone_ids"] = with_views("SELECT * FROM phones")
ORACLES["person_ids"] = with_views("SELECT * FROM persons")
_CONTACT = "NoMobile, Email, combinaison, GoodEmail, GoodCombinaison"
CTES["ambiguity"] = f"""SELECT {_CONTACT}, num_cards, CAST(sum(num_cards) OVER (PARTITION BY Email) AS BIGINT) AS num_email,
 CAST(sum(num_cards) OVER (PARTITION BY NoMobile) AS BIGINT) AS num_nomobile
 FROM (SELECT {_CONTACT}, count(*) AS num_cards FROM base GROUP BY ALL)"""
ORACLES["contact_ambiguity"] = with_views("SELECT * FROM ambiguity")
ORACLES["ambiguous_contacts"] = with_views("SELECT * FROM ambiguity WHERE num_email > 1 OR num_nomobile > 1")


def _components(tag: str, source: str, where: str = "true") -> dict[str, str]:
    """Views that label the contacts of `source`: c_<tag> has id and root."""
    return {
        f"n_{tag}": f"SELECT *, row_number() OVER (ORDER BY {_CONTACT}) AS id FROM (SELECT DISTINCT {_CONTACT} FROM {source} WHERE {where})",
        f"l_{tag}": f"""SELECT a.id AS a, b.id AS b FROM n_{tag} a JOIN n_{tag} b ON a.NoMobile = b.NoMobile UNION
 SELECT a.id, b.id FROM n_{tag} a JOIN n_{tag} b ON a.Email = b.Email AND a.GoodEmail = 1 AND b.GoodEmail = 1 UNION
 SELECT a.id, b.id FROM n_{tag} a JOIN n_{tag} b ON a.combinaison = b.combinaison AND a.GoodCombinaison = 1 AND b.GoodCombinaison = 1""",
        f"r_{tag}": f"SELECT id, id AS root FROM n_{tag} UNION SELECT l.b, r.root FROM r_{tag} r JOIN l_{tag} l ON l.a = r.id",
        f"c_{tag}": f"SELECT n.*, root FROM n_{tag} n JOIN (SELECT id, min(root) AS root FROM r_{tag} GROUP BY id) USING (id)",
    }


_FULL = _components("full", "base")
_EARLY = _components("early", "base", "early")
_LATE = _components("late", "base", "NOT early")
_USERS = {
    "u_early": f"SELECT {_CONTACT}, dense_rank() OVER (ORDER BY root) AS USER_ID FROM c_early",
    "u_late": f"SELECT {_CONTACT}, dense_rank() OVER (ORDER BY root) + 1000000 AS USER_ID FROM c_late",
    "known_root": f"""SELECT root, min(USER_ID) AS k FROM c_full LEFT JOIN u_early USING ({_CONTACT}) GROUP BY root""",
    "u_full": f"""SELECT {_CONTACT}, coalesce(k, (SELECT max(USER_ID) FROM u_early) + fresh) AS USER_ID FROM c_full
 JOIN (SELECT root, k, sum(CASE WHEN k IS NULL THEN 1 ELSE 0 END) OVER (ORDER BY root) AS fresh FROM known_root) USING (root)""",
    "by_phone_early": "SELECT NoMobile, min(USER_ID) AS USER_ID FROM u_early GROUP BY NoMobile",
    "by_phone_full": "SELECT NoMobile, min(USER_ID) AS USER_ID FROM u_full GROUP BY NoMobile",
}
for _t, _ph, _w in [("m1", "by_phone_early", "early"), ("m2", "by_phone_full", "true")]:
    _USERS[_t] = f"""SELECT CardHolderID, b.NoMobile, Email, LastName, GoodEmail, GoodCombinaison, MOBILE_ID, u.USER_ID, CardHolderID AS CONTACT_ID,
 CASE WHEN GoodCombinaison = 1 THEN CAST(p.PERSON_ID AS VARCHAR) ELSE CAST(u.USER_ID AS VARCHAR) || '_' || CAST(MOBILE_ID AS VARCHAR) END AS PERSON_ID
 FROM base b JOIN phones USING (NoMobile) LEFT JOIN persons p ON p.combinaison = b.combinaison
 LEFT JOIN {_ph} u ON u.NoMobile = b.NoMobile WHERE {_w}"""
_USERS["id_moves"] = """SELECT o.USER_ID AS old, min(n.USER_ID) AS cur FROM m1 o JOIN m2 n USING (CardHolderID)
 WHERE o.USER_ID <> n.USER_ID GROUP BY o.USER_ID"""
_USERS["stale_users"] = f"SELECT {_CONTACT}, USER_ID FROM u_full UNION ALL SELECT {_CONTACT}, USER_ID FROM u_early"
_USERS["moved_users"] = f"SELECT {_CONTACT}, coalesce(cur, USER_ID) AS USER_ID FROM stale_users LEFT JOIN id_moves ON old = USER_ID"
_MAIL1 = {
    "next_base": "SELECT *, CAST(BirthDate AS VARCHAR) || LastName AS combinaison, 1 AS ge, 0 AS gc FROM fx_next WHERE NoMobile IS NOT NULL",
    "next_contacts": "SELECT NoMobile, Email, combinaison, 1 AS GoodEmail, 0 AS GoodCombinaison FROM next_base",
    **_components("next", "next_contacts"),
}


def _identity(body: str, extra: dict[str, str]) -> str:
    return with_views(body, extra, recursive=True)


_EVERY = {**_FULL, **_EARLY, **_LATE, **_USERS}
ORACLES["resolve_users"] = _identity(f"SELECT {_CONTACT}, dense_rank() OVER (ORDER BY root) AS USER_ID FROM c_full", _FULL)
ORACLES["bootstrap_users"] = _identity(f"SELECT {_CONTACT}, dense_rank() OVER (ORDER BY root) AS USER_ID FROM c_next", _MAIL1)
ORACLES["resolve_incremental"] = _identity("SELECT * FROM u_full", _EVERY)
ORACLES["conflicting_keys"] = _identity("""
SELECT 'NoMobile' AS key_kind, NoMobile AS key_value, count(DISTINCT USER_ID) AS num_users
FROM (SELECT * FROM u_early UNION ALL SELECT * FROM u_late) GROUP BY NoMobile HAVING count(DISTINCT USER_ID) > 1 UNION ALL
SELECT 'Email', Email, count(DISTINCT USER_ID) FROM (SELECT * FROM u_early UNION ALL SELECT * FROM u_late) WHERE GoodEmail = 1
GROUP BY Email HAVING count(DISTINCT USER_ID) > 1 UNION ALL
SELECT 'combinaison', combinaison, count(DISTINCT USER_ID) FROM (SELECT * FROM u_early UNION ALL SELECT * FROM u_late)
WHERE GoodCombinaison = 1 GROUP BY combinaison HAVING count(DISTINCT USER_ID) > 1""", _EVERY)
ORACLES["master"] = _identity("SELECT * FROM m2", _EVERY)
ORACLES["user_changes"] = _identity("""SELECT n.* EXCLUDE (USER_ID), o.USER_ID, TIMESTAMP '2024-02-14 06:00:00' AS dt_change
FROM m2 n JOIN m1 o USING (CardHolderID) WHERE o.USER_ID <> n.USER_ID""", _EVERY)
ORACLES["bootstrap_users_keys"] = ORACLES["resolve_users"]
ORACLES["propagate_log"] = _identity("""SELECT n.* EXCLUDE (USER_ID), o.USER_ID, TIMESTAMP '2024-02-14 06:00:00' AS dt_change
FROM m2 n JOIN m1 o USING (CardHolderID) WHERE o.USER_ID <> n.USER_ID UNION ALL BY NAME
SELECT m2.*, TIMESTAMP '2024-02-14 06:00:00' AS dt_change FROM m2 WHERE USER_ID IN (SELECT old FROM id_moves)""", _EVERY)
ORACLES["propagate_users"] = _identity("SELECT * FROM moved_users", _EVERY)
ORACLES["propagate_master"] = _identity("""
SELECT m2.* EXCLUDE (USER_ID, PERSON_ID), u.USER_ID,
 CASE WHEN GoodCombinaison = 0 THEN CAST(u.USER_ID AS VARCHAR) || '_' || CAST(MOBILE_ID AS VARCHAR) ELSE PERSON_ID END AS PERSON_ID
FROM m2 LEFT JOIN (SELECT NoMobile, min(USER_ID) AS USER_ID FROM moved_users GROUP BY NoMobile) u ON u.NoMobile = m2.NoMobile""", _EVERY)
ORACLES["attach_users"] = _identity("""
SELECT CardHolderID, b.NoMobile, coalesce(u.USER_ID, k.USER_ID) AS USER_ID FROM base b
LEFT JOIN by_phone_early u ON u.NoMobile = b.NoMobile
LEFT JOIN (SELECT combinaison, min(USER_ID) AS USER_ID FROM u_early WHERE GoodCombinaison = 1 GROUP BY combinaison) k
 ON k.combinaison = b.combinaison AND b.GoodCombinaison = 1""", _EVERY)
ORACLES["cards_to_resolve"] = with_views("""
SELECT CardHolderID, NoMobile, Email FROM fx_next WHERE NoMobile IS NOT NULL AND NOT regexp_matches(Email, 'u1[0-9]0@', 'i')
  AND CardHolderID NOT IN (SELECT CardHolderID FROM fx_cards WHERE GoodEmail = 1)
UNION ALL
SELECT CardHolderID, NoMobile, Email FROM fx_next WHERE CardHolderID IN (SELECT CardHolderID FROM fx_cards WHERE GoodEmail = 1)
  AND CardHolderID IN (SELECT CardHolderID FROM customer_log WHERE (Is_ch_BirthDate = 1 OR Is_ch_Email = 1 OR Is_ch_LastName = 1 OR Is_ch_NoMobile = 1)
    AND NoMobile IS NOT NULL AND NOT regexp_matches(Email, 'u1[0-9]0@', 'i'))""")

# --- clusters, merchants, tables
_DIMS = 64
_CENTERS = [[0.05 * ((i * 7 + j * 3) % 11 - 5) for j in range(_DIMS)] for i in range(4)]


def _dist(center: list[float]) -> str:
    return "sqrt(" + " + ".join(f"power(CAST(embedding[{j + 1}] AS DOUBLE) - ({c!r}), 2)" for j, c in enumerate(center)) + ")"


CTES["d4"] = "SELECT CAST(vec_id AS VARCHAR) AS CardHolderID, " + ", ".join(
    f"{_dist(c)} AS d{i}" for i, c in enumerate(_CENTERS)) + " FROM embeddings"
CTES["scored"] = """SELECT CardHolderID, CASE least(d0, d1, d2, d3) WHEN d0 THEN 0 WHEN d1 THEN 1 WHEN d2 THEN 2 ELSE 3 END AS ClusterID,
 least(d0, d1, d2, d3) AS min_distance, (d0 + d1 + d2 + d3 - least(d0, d1, d2, d3)) / 3 AS avg_distance_other_clusters FROM d4"""
ORACLES["score_clusters"] = with_views("""SELECT CardHolderID, ClusterID, round(min_distance, 6) AS min_distance,
 round(avg_distance_other_clusters, 6) AS avg_distance_other_clusters,
 round(abs(avg_distance_other_clusters - min_distance), 6) AS std_distance_other_clusters, '' AS ClusterLabels FROM scored""")
ORACLES["distance_distribution"] = with_views("""SELECT ClusterID, count(*) AS n, round(min(min_distance), 6) AS d_min,
 round(quantile_cont(min_distance, 0.25), 6) AS d_q1, round(quantile_cont(min_distance, 0.5), 6) AS d_median,
 round(quantile_cont(min_distance, 0.75), 6) AS d_q3, round(max(min_distance), 6) AS d_max, round(avg(min_distance), 6) AS d_avg
FROM scored GROUP BY ClusterID""")
ORACLES["clusters"] = """SELECT CAST(4 AS BIGINT) AS n_clusters, count(*) AS n_members, true AS size_agrees, true AS all_nearest,
 true AS centre_is_mean, true AS one_label FROM embeddings"""
ORACLES["feature_importance"] = """SELECT CAST(64 AS BIGINT) AS n_rows, CAST(64 AS BIGINT) AS n_features, CAST(1 AS DOUBLE) AS total,
 true AS none_below_0, true AS some_above_0"""
ORACLES["top_merchants"] = with_views("""SELECT MerchantName, count(*) AS nb_transactions FROM pos_long
WHERE CAST(CardHolderID AS BIGINT) % 5 = 3 AND CardHolderID IN (SELECT CardHolderID FROM fx_cards)
  AND TransactionTime > '1997-08-01' GROUP BY MerchantName ORDER BY 2 DESC, 1 LIMIT 10""")
ORACLES["infer_column_types"] = """
SELECT 'p_partkey' AS "column", 'INTEGER' AS type UNION ALL
SELECT 'p_name', CASE WHEN max(length(p_name)) <= 20 THEN 'VARCHAR (40)' ELSE 'TEXT' END FROM part UNION ALL
SELECT 'p_brand', 'TEXT' UNION ALL
SELECT 'p_type', CASE WHEN max(length(p_type)) <= 20 THEN 'VARCHAR (40)' ELSE 'TEXT' END FROM part UNION ALL
SELECT 'p_size', 'INTEGER' UNION ALL SELECT 'p_retailprice', 'double precision'"""
ORACLES["table_profile"] = "SELECT count(*) AS num_rows, CAST(6 AS INT) AS num_columns FROM part"
ORACLES["landing_days"] = """
WITH days AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders)
SELECT 'transactions' AS kind, 'A_' || strftime(day, '%d%m%y') || '_1.csv' AS file_name,
 CAST('20' || strftime(day, '%y-%m-%d') AS DATE) AS file_day,
 CAST('20' || strftime(day, '%y-%m-%d') AS DATE) - 1 BETWEEN DATE '2096-01-01' AND DATE '2096-12-31' AS inside
FROM days UNION ALL
SELECT 'activations', 'report_' || strftime(day, '%Y%m%d') || '12.csv', day, day BETWEEN DATE '1996-01-01' AND DATE '1996-12-31'
FROM days UNION ALL
SELECT 'status', 'cards-' || strftime(day, '%Y-%m-%d') || '.csv', day, day BETWEEN DATE '1996-01-01' AND DATE '1996-12-31'
FROM days"""
ORACLES["export_and_read"] = with_views(
    "SELECT TransactionID, CardHolderID, CAST(Amount AS DOUBLE) AS Amount, MerchantName FROM fx_tx")
ORACLES["ingest_files"] = with_views("SELECT TransactionID, CardHolderID, CAST(Amount AS DOUBLE) * 2 AS Amount FROM fx_tx")
ORACLES["ingest_file_per_table"] = with_views("SELECT TransactionID, CardHolderID FROM fx_tx")
ORACLES["archive_copy"] = ORACLES["ingest_file_per_table"]
ORACLES["write_monthly"] = with_views("""SELECT TransactionID, CardHolderID, TransactionTime, CAST(Amount AS DOUBLE) AS Amount,
 CAST(year(TransactionTime) AS INT) AS year, CAST(month(TransactionTime) AS INT) AS month FROM fx_long
 WHERE TransactionTime >= '1996-01-01' AND TransactionTime < '1996-04-01'""")
ORACLES["read_months"] = ORACLES["write_monthly"]
ORACLES["write_monthly"] = ORACLES["write_monthly"].split(" WHERE TransactionTime >= '1996-01-01'")[0]
ORACLES["append_day"] = with_views("SELECT TransactionID, CardHolderID, TransactionTime FROM atm_tx")
ORACLES["refresh_snapshot"] = with_views("SELECT CardHolderID, NoMobile, 'SDD' AS KYC_Status FROM fx_cards WHERE NoMobile <> '3360'")
ORACLES["write_table"] = with_views(
    "SELECT CardHolderID, TransactionTP, CAST(Amount AS DOUBLE) AS Amount FROM fx_tx CROSS JOIN (VALUES (1), (2)) AS twice(i)")

"""Card data derived from the test tables, as SQL both engines run.

`{events}`, `{lineitem}`, … stand for tables and `{ntz}` for the timestamp type
without zone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

FX_TX = """
SELECT CAST(event_id AS STRING) AS TransactionID, CAST(user_id AS STRING) AS CardHolderID,
  ts AS TransactionTime, CAST(value AS DECIMAL(18,2)) AS Amount,
  CASE event_type
    WHEN 'purchase' THEN CASE WHEN event_id % 5 = 0 THEN 'POS International' ELSE 'POS Domestic' END
    WHEN 'click' THEN CASE WHEN event_id % 7 = 0 THEN 'ATM International' ELSE 'ATM Domestic' END
    WHEN 'view' THEN CASE event_id % 4 WHEN 0 THEN 'Card to Card Out' WHEN 1 THEN 'Bank Payment'
                                       WHEN 2 THEN 'Purchase Reversal' ELSE 'Dormancy Fee' END
    WHEN 'signup' THEN CASE event_id % 3 WHEN 0 THEN 'Voucher load' WHEN 1 THEN 'Terminal Load'
                                         ELSE 'Sepa Incoming Payment' END
    ELSE CASE event_id % 3 WHEN 0 THEN 'FX Fee' WHEN 1 THEN 'ATM Domestic Fee'
                           ELSE 'POS Domestic Auth' END END AS TransactionTP,
  CASE WHEN event_type = 'signup' THEN 'Credit' ELSE 'Debit' END AS DebitCredit,
  CASE WHEN event_id % 11 = 0 THEN 'DECLINED' ELSE 'APPROVED' END AS TransactionResult,
  CAST(CASE WHEN event_type = 'error' THEN value ELSE 0 END AS DECIMAL(18,2)) AS Fee,
  CAST(CASE WHEN event_type = 'error' AND event_id % 2 = 0 THEN -value ELSE 0 END AS DECIMAL(18,2)) AS Surcharge,
  CAST(1000 - value AS DECIMAL(18,2)) AS RemainingBalance, 'EUR' AS Currency,
  CONCAT('M', CAST(event_id % 6 AS STRING)) AS MCC,
  CONCAT('shop ', CAST(event_id % 53 AS STRING)) AS MerchantName,
  CONCAT('s', CAST(event_id % 53 AS STRING)) AS MerchantID, 'a street' AS MerchantAddress,
  'a town' AS MerchantCity, 'FR' AS MerchantCountry, 'plastic' AS CardVPUType
FROM {events}
"""

FX_TX_LONG = """
SELECT CONCAT(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING)) AS TransactionID,
  CAST(o_custkey AS STRING) AS CardHolderID, l_shipdate AS TransactionTime,
  CAST(l_extendedprice AS DECIMAL(18,2)) AS Amount,
  p_type AS MCC, p_name AS MerchantName, p_brand AS MerchantID,
  CASE WHEN l_returnflag = 'N' THEN 'ATM Domestic' WHEN l_linestatus = 'O' THEN 'POS International'
       ELSE 'POS Domestic' END AS TransactionTP,
  'Debit' AS DebitCredit, 'APPROVED' AS TransactionResult,
  CAST(l_quantity AS DECIMAL(18,2)) AS RemainingBalance, CAST(0 AS DECIMAL(18,2)) AS Fee,
  CAST(0 AS DECIMAL(18,2)) AS Surcharge, 'EUR' AS Currency, 'a street' AS MerchantAddress,
  'a town' AS MerchantCity, 'FR' AS MerchantCountry, 'plastic' AS CardVPUType
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey JOIN {part} ON l_partkey = p_partkey
"""

FX_CARDS = """
SELECT CAST(c_custkey AS STRING) AS CardHolderID,
  CONCAT('336', CAST(c_custkey % 1000 AS STRING)) AS NoMobile,
  CONCAT('u', CAST((c_custkey * 7) % 1200 AS STRING), '@x.org') AS Email,
  CONCAT('n', CAST((c_custkey * 13) % 1300 AS STRING)) AS LastName,
  CONCAT('f', CAST(c_nationkey AS STRING)) AS FirstName,
  CAST(CONCAT(CAST(1950 + c_custkey % 50 AS STRING), '-06-15 00:00:00') AS {ntz}) AS BirthDate,
  CASE WHEN c_custkey % 3 = 0 THEN 0 ELSE 1 END AS GoodEmail,
  CASE WHEN c_custkey % 4 = 0 THEN 0 ELSE 1 END AS GoodCombinaison,
  CASE c_nationkey % 4 WHEN 0 THEN 'Anonyme' WHEN 1 THEN 'SDD' WHEN 2 THEN 'KYC' ELSE 'KYC LITE' END AS KYC_Status,
  c_mktsegment AS CardStatus, CONCAT('FR', CAST(c_custkey AS STRING)) AS IBAN, 'classic' AS Programme,
  CONCAT(CAST(c_nationkey AS STRING), ' Main Street') AS Address1, 'floor 1' AS Address2,
  CAST(10000 + c_custkey % 90000 AS STRING) AS PostCode, 'Paris' AS City,
  CASE WHEN c_custkey % 2 = 0 THEN CAST('2020-01-01 00:00:00' AS {ntz}) END AS ActivationDate,
  CAST(NULL AS {ntz}) AS LastChangeDate
FROM {customer}
"""

# the snapshot of the next day: changed attributes, closed cards and new cards
FX_CARDS_NEXT = """
SELECT CASE WHEN c_custkey % 31 = 0 THEN CONCAT('new', CAST(c_custkey AS STRING))
            ELSE CAST(c_custkey AS STRING) END AS CardHolderID,
  CASE WHEN c_custkey % 17 = 0 THEN CAST(NULL AS STRING)
       ELSE CONCAT('336', CAST(c_custkey % 1000 AS STRING)) END AS NoMobile,
  CONCAT('u', CAST((c_custkey * 7) % 1200 AS STRING), CASE WHEN c_custkey % 13 = 0 THEN '@y.org' ELSE '@x.org' END) AS Email,
  CONCAT(CASE WHEN c_custkey % 10 = 1 THEN 'n ' ELSE 'n' END, CAST((c_custkey * 13) % 1300 AS STRING)) AS LastName,
  CONCAT('f', CAST(c_nationkey AS STRING)) AS FirstName,
  CAST(CONCAT(CAST(1950 + c_custkey % 50 AS STRING), '-06-15 00:00:00') AS {ntz}) AS BirthDate,
  CASE WHEN c_custkey % 23 = 0 THEN 'KYC' WHEN c_nationkey % 4 = 0 THEN 'Anonyme' WHEN c_nationkey % 4 = 1 THEN 'SDD'
       WHEN c_nationkey % 4 = 2 THEN 'KYC' ELSE 'KYC LITE' END AS KYC_Status,
  CASE WHEN c_custkey % 19 = 0 THEN CAST(NULL AS STRING) ELSE c_mktsegment END AS CardStatus,
  CONCAT('FR', CAST(c_custkey AS STRING)) AS IBAN,
  CASE WHEN c_acctbal < 0 THEN 'gold' ELSE 'classic' END AS Programme,
  CONCAT(CAST(c_nationkey AS STRING), CASE WHEN c_custkey % 7 = 0 THEN ' High Street' ELSE ' MAIN  Street' END) AS Address1,
  'floor 1' AS Address2, CAST(10000 + c_custkey % 90000 AS STRING) AS PostCode,
  CASE WHEN c_custkey % 29 = 0 THEN 'Lyon' ELSE 'Paris' END AS City
FROM {customer}
"""

# landing rows: text as it arrives in the files
FX_RAW = """
SELECT CONCAT('''', CAST(event_id AS STRING)) AS TransactionID, CAST(user_id AS STRING) AS CardHolderID,
  CAST(CAST(ts AS DATE) AS STRING) AS Date,
  CASE WHEN event_id % 41 = 0 THEN 'no time' ELSE SUBSTRING(CAST(ts AS STRING), 12, 8) END AS Time,
  'Ann' AS FirstName, CAST(CAST(CASE WHEN event_id % 2 = 0 THEN -value ELSE value END AS DECIMAL(18,2)) AS STRING) AS Amount,
  CASE event_id % 4 WHEN 0 THEN 'CHROMERECON_' WHEN 1 THEN 'BLACKRECON_' WHEN 2 THEN 'INFINITYRECON_' ELSE 'X_' END AS f1,
  CASE WHEN event_id % 37 = 0 THEN '010124' ELSE
    CONCAT(SUBSTRING(CAST(CAST(ts AS DATE) + INTERVAL '1' DAY AS STRING), 9, 2),
           SUBSTRING(CAST(CAST(ts AS DATE) + INTERVAL '1' DAY AS STRING), 6, 2),
           SUBSTRING(CAST(CAST(ts AS DATE) + INTERVAL '1' DAY AS STRING), 3, 2)) END AS f2,
  CASE WHEN event_id % 43 = 0 THEN '_extra_1.csv' ELSE '_1.csv' END AS f3,
  event_type AS Description, CAST(event_id % 900 AS STRING) AS DistributorCode
FROM {events}
"""

FX_STATUS_FILE = """
SELECT CAST(c_custkey AS STRING) AS CardHolderID, 'x' AS Cardnumber, CONCAT('U', CAST(c_custkey AS STRING), '@X.org') AS Email,
  'Ann' AS FirstName, CONCAT('n', CAST(c_custkey % 1300 AS STRING)) AS LastName, 'Paris' AS City, 'FR' AS Country,
  c_mktsegment AS "Card Status", CASE c_custkey % 5 WHEN 0 THEN '203' WHEN 1 THEN '914.0' WHEN 2 THEN '7' ELSE NULL END AS DistributorCode,
  'app' AS ApplicationName,
  CASE WHEN c_custkey % 6 = 0 THEN 'bad' ELSE CONCAT('Jan  ', CAST(1 + c_custkey % 9 AS STRING), ' ', CAST(1950 + c_custkey % 50 AS STRING), ' 12:00AM') END AS "Date of Birth",
  's' AS SortCodeAccNum, CONCAT('FR', CAST(c_custkey AS STRING)) AS IBAN,
  CONCAT('Nov ', CAST(10 + c_custkey % 19 AS STRING), ' 2018  3:0', CAST(c_custkey % 10 AS STRING), 'PM') AS CreatedDate,
  'Dec 31 2018 11:59PM' AS UpdatedDate,
  CASE WHEN c_custkey % 8 = 0 THEN 'ADDRESS' ELSE '1 Main Street' END AS Address1, 'floor 1' AS Address2, '75001' AS PostCode,
  CASE c_custkey % 6 WHEN 0 THEN '0' WHEN 1 THEN '1.0' WHEN 2 THEN '2' WHEN 3 THEN '3.0' WHEN 4 THEN '9' ELSE NULL END AS "KYC Status",
  CASE WHEN c_custkey % 9 = 0 THEN '2099' ELSE CONCAT('2', CAST(c_custkey % 10 AS STRING), '0', CAST(1 + c_custkey % 9 AS STRING)) END AS expirydate,
  CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS STRING) AS AvailableBalance, 'u' AS UDF2,
  CASE c_custkey % 4 WHEN 0 THEN CONCAT('00336', CAST(c_custkey AS STRING)) WHEN 1 THEN CONCAT('336', CAST(c_custkey AS STRING), '.0')
       WHEN 2 THEN CONCAT('33|6', CAST(c_custkey AS STRING)) ELSE NULL END AS NoMobile,
  'classic' AS Programme, 'v' AS VPVR
FROM {customer}
"""

# (TransactionTP, group_transactions, IsVolontaire)
TYPES = [
    ("POS Domestic", "POS", 1), ("POS International", "POS", 1), ("ATM Domestic", "ATM", 1),
    ("ATM International", "ATM", 1), ("Voucher load", "LOAD", 1), ("Terminal Load", "LOAD", 1),
    ("Sepa Incoming Payment", "Virement entrant", 0), ("Card to Card Out", "Card to card out", 1),
    ("Bank Payment", "Virement sortant", 0),
]

# (UNIVERS_DATABASE, SOUS_UNIVERS_DATABASE, UNIVERS, SOUS_UNIVERS)
CATEGORIES = [
    ("FOOD", "GROCERY", "Food", "Grocery"), ("HOME", "TOOLS", "Home", "Tools"),
    ("TRAVEL", "HOTEL", "Travel", "Hotel"), ("LEISURE", "GAMES", "Leisure", "Games"),
    ("OTHER", "MISC", "Other", "Misc"),
]
MCC_LINK = [("c1", "ECONOMY"), ("c2", "LARGE"), ("c3", "MEDIUM"), ("c4", "PROMO"), ("c5", "SMALL"), ("c6", "STANDARD")]
# (MCC_NAME, SOUS_UNIVERS, UNIVERS, MCC_CODE, NOTE)
MCC_CATEGORIES = [
    ("economy shops", "Grocery", "Food", "c1", 1), ("large shops", "Tools", "Home", "c2", 1),
    ("medium shops", "Hotel", "Travel", "c3", 0), ("promo shops", "Games", "Leisure", "c4", 2),
    ("small shops", "Nowhere", "Nothing", "c5", 1),
]
# (MCC, UNIVERS, SOUS_UNIVERS, NEW_REGEX, rule_order)
OVERRIDE = [
    ("economy shops", "Home", "Tools", "anvil$|BOLT", 1), ("economy shops", "Travel", "Hotel", "^blue", 2),
    ("promo shops", "Other", "Misc", "ring|rod", 3), ("small shops", "Food", "Grocery", "\\mred\\M", 4),
    ("large shops", None, "Misc", "gear", 5), ("medium shops", "Leisure", "Games", "g[[:alpha:]]+r$", 6),
]
# (UNIVERS, SOUS_UNIVERS, NEW_REGEX, rule_order)
FILL = [("Leisure", "Games", "Widget", 1), ("Food", "Grocery", "^(old|new) ", 2), ("Other", "Misc", "g[[:alpha:]]zmo", 3),
        (None, None, "plate", 4)]

TABLES = ["events", "lineitem", "orders", "customer", "part"]


def view(spark: SparkSession, folder: str, text: str) -> DataFrame:
    """Run a fixture on Spark."""
    used = [t for t in TABLES if "{" + t + "}" in text]
    frames = {t: spark.read.parquet(f"{folder}/{t}.parquet") for t in used}
    text = text.replace("{ntz}", "TIMESTAMP_NTZ").replace('"Card Status"', "`Card Status`")
    text = text.replace('"Date of Birth"', "`Date of Birth`").replace('"KYC Status"', "`KYC Status`")
    return spark.sql(text, **frames)


def portable(text: str) -> str:
    """The same fixture for DuckDB."""
    for t in TABLES:
        text = text.replace("{" + t + "}", t)
    return text.replace("{ntz}", "TIMESTAMP")

"""Guest, booking, party and transaction tables derived from the driver's parquet tables.

A customer's account is one source record, and each desk that took an order of theirs holds another, so records
follow from ``customer`` and ``orders``; every order is one visit with its spend. Names are spelled from the digits
of the customer's name, in one of five scripts; what a desk leaves out or writes differently follows from market
segment, nation and balance. The statements use only functions that mean the same in Spark SQL and in ANSI
engines; ``{customer}`` and ``{orders}`` name the inputs.

Shape: customers whose key is a multiple of three travel in parties of up to five consecutive
orders and form one large connected group, a third of all guests. The others travel inside small
circles of neighbouring keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kinweave.session import exchanged

# Letters for the ten digits, by script.
LETTERS = ("aeioulnrst", "аеиоунлрст", "αειουλνρστ", "ابتجدرسلمن", "山川田中木林森石水金")

# The desk that took an order: 0 for the account itself.
DESK = """CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' THEN 1
        WHEN o_orderstatus = 'F' AND o_orderpriority = '2-HIGH' THEN 2 ELSE 0 END"""


def _spelled(digits: str) -> str:
    cases = " ".join(f"WHEN {i} THEN translate({digits}, '0123456789', '{letters}')" for i, letters in enumerate(LETTERS))
    return f"CASE street % {len(LETTERS)} {cases} END"


# 51 neighbouring customers live in a street and write in one script, three share a last name, two a phone.
GUESTS_RAW = f"""
WITH desk AS (SELECT DISTINCT o_custkey AS k, {DESK} AS s FROM {{orders}}),
seen AS (SELECT c_custkey AS k, 0 AS s FROM {{customer}} UNION ALL SELECT k, s FROM desk WHERE s > 0),
known AS (SELECT seen.k, s, c_nationkey AS nation, c_mktsegment AS segment, c_acctbal AS balance, lower(c_name) AS name,
        CAST(substr(c_name, 10) AS BIGINT) AS num FROM seen JOIN {{customer}} ON c_custkey = seen.k),
placed AS (SELECT *, CAST((num - num % 51) / 51 AS BIGINT) AS street FROM known),
named AS (SELECT *, {_spelled("lpad(CAST(num * 37 % 100000 AS STRING), 5, '0')")} AS first,
        {_spelled("lpad(CAST((num - num % 3) * 91 % 10000 AS STRING), 4, '0')")} AS last FROM placed)
SELECT 'r' || lpad(CAST(k * 3 + s AS STRING), 12, '0') AS record_id,
  CASE s WHEN 0 THEN 'account' WHEN 1 THEN 'urgent' ELSE 'high' END AS source_system,
  CASE WHEN s = 1 AND segment IN ('BUILDING', 'HOUSEHOLD') THEN substr(first, 1, 1) || '.' ELSE first END AS first_name,
  CASE WHEN s = 2 AND nation % 3 = 0 THEN substr(last, 1, 1) || substr(last, 3, 1) || substr(last, 2, 1) || substr(last, 4) ELSE last END AS last_name,
  CASE WHEN s < 2 OR balance >= 1000 THEN replace(name, '#', CASE WHEN s = 1 AND nation % 2 = 0 THEN '.' ELSE '' END)
       || '@' || lower(segment) || '.example' END AS email,
  CASE WHEN s <> 1 OR balance >= 0 THEN '4' || lpad(CAST(nation AS STRING), 2, '0') || lpad(CAST(num - num % 2 AS STRING), 9, '0') END AS phone,
  CASE WHEN s < 2 OR segment <> 'MACHINERY' THEN substr('BLMS', CAST(1 + street % 4 AS INT), 1)
       || CAST(1 + street % 12 AS STRING) || ' ' || CAST(street AS STRING) || 'AA' END AS postcode,
  CASE WHEN s = 0 OR nation % 4 <> s THEN CAST(1940 + nation * 3 AS STRING) || '-' || lpad(CAST(1 + num % 12 AS STRING), 2, '0')
       || '-' || lpad(CAST(1 + num * 5 % 28 AS STRING), 2, '0') END AS dob,
  'park' || CAST(nation % 6 AS STRING) AS home_park, k AS true_id
FROM named
"""

# Every order with its customer, the desk that took it and the party it belongs to.
VISITS = f"""
SELECT ok, k, s, amount, visit_ts,
  CASE WHEN k % 3 = 0 THEN '0' || lpad(CAST(ok - ok % 5 AS STRING), 14, '0')
       ELSE '1' || lpad(CAST(k - (k % 60) % w AS STRING), 12, '0') || lpad(CAST(ok % (3 * w) AS STRING), 2, '0') END AS party
FROM (SELECT o_orderkey AS ok, o_custkey AS k, o_totalprice AS amount, o_orderdate AS visit_ts, {DESK} AS s,
        3 * (1 + CAST((o_custkey - o_custkey % 60) / 60 AS BIGINT) % 5) AS w
      FROM {{orders}}) AS o
"""

PARTY_MEMBERS = f"""
SELECT DISTINCT 'p' || party AS party_id, 'r' || lpad(CAST(k * 3 + s AS STRING), 12, '0') AS record_id,
  'b' || party AS booking_id
FROM ({VISITS}) AS v
"""

# The customer of a party's first order pays, under the record of the desk that took it.
BOOKINGS = f"""
SELECT 'b' || party AS booking_id, 'p' || party AS party_id,
  'r' || lpad(CAST(k * 3 + s AS STRING), 12, '0') AS payer_record_id,
  'park' || CAST(k % 6 AS STRING) AS park, CAST(CAST(visit_ts AS DATE) AS STRING) AS booking_date
FROM (SELECT party, min(ok) AS ok, min_by(k, ok) AS k, min_by(s, ok) AS s, min_by(visit_ts, ok) AS visit_ts
      FROM ({VISITS}) AS v GROUP BY party) AS b
"""

TRANSACTIONS = f"""
SELECT 't' || lpad(CAST(ok AS STRING), 14, '0') AS txn_id, 'r' || lpad(CAST(k * 3 + s AS STRING), 12, '0') AS record_id,
  'park' || CAST(k % 6 AS STRING) AS park, amount AS amount_gbp, CAST(CAST(visit_ts AS DATE) AS STRING) AS txn_date
FROM ({VISITS}) AS v
"""

SOURCE_SQL = {
    "guests_raw": GUESTS_RAW,
    "party_members": PARTY_MEMBERS,
    "bookings": BOOKINGS,
    "transactions": TRANSACTIONS,
}


def derive(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One of the four source tables, derived from the parquet tables under ``sf_dir``."""
    base = ("customer", "orders") if table == "guests_raw" else ("orders",)
    return spark.sql(SOURCE_SQL[table], **{name: exchanged(spark.read.parquet(f"{sf_dir}/{name}.parquet")) for name in base})

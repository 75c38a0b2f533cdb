"""Journal-line input derived from the driver's TPC-H-like tables.

Each line item becomes a debit and a credit journal line of its order; every
tenth order is delivered twice (re-delivery, for de-duplication and idempotency).
The result looks like a raw batch file: text amounts, aliased column names
(``line_num``, ``acct_date``) and no ``segment7_spare``, so the canonical
projection does real work. Planted defects: null dates, null rates, blank
accounts, non-primary ledgers and a 0.01 credit surplus on some journals.

Join plan: orders take the customer dimension (customer, nation, region; nation
and region are tiny and broadcast by Catalyst's size check) first, so the line
items stream through two joins only: part on the part key, while they are narrow,
and orders on the order key. Small sides are broadcast by Catalyst/AQE from
measured sizes; at scale the joins shuffle on their keys. The joined line items
are a lake table, written once per input version: what reads the lines several
times does not join again. The side/delivery expansion happens after the joins,
so shuffles and table carry one row per line item, not two to four.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fxlake.operators.util import spread_scan
from fxlake.schema import AMOUNT_TYPE, RATE_TYPE
from fxlake.session import input_fingerprint, lake_table

# Fixed values of the fixture derivation.
LEDGER_BY_RETURNFLAG = {"A": "AP", "R": "AR", "N": "IC"}
CURRENCY_BY_REGION = {"AFRICA": "ZAR", "AMERICA": "USD", "ASIA": "JPY", "EUROPE": "EUR"}
OTHER_CURRENCY = "AED"
NO_GEO_REGION = "ANTARCTICA"   # an expected geo without any line
REGION_NAMES = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
FIXTURE_GEOS = [*REGION_NAMES, NO_GEO_REGION]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _case(col, mapping: dict, other=None):
    expr = None
    for k, v in mapping.items():
        expr = (F.when(col == F.lit(k), F.lit(v)) if expr is None
                else expr.when(col == F.lit(k), F.lit(v)))
    return expr.otherwise(F.lit(other)) if other is not None else expr


def _amount_text(col):
    return col.cast(AMOUNT_TYPE).cast("string")


def _joined_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with their order, customer, nation, region and part."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice",
        "l_returnflag", "l_linestatus")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_brand")

    cust = (customer
            .join(nation, customer.c_nationkey == nation.n_nationkey)
            .join(region, nation.n_regionkey == region.r_regionkey)
            .select("c_custkey", "c_mktsegment", "n_nationkey", "n_name", "r_name"))
    placed = orders.join(cust, orders.o_custkey == cust.c_custkey).drop("o_custkey", "c_custkey")
    return (spread_scan(li)
            .join(part, li.l_partkey == part.p_partkey).drop("p_partkey")
            .join(placed, li.l_orderkey == placed.o_orderkey).drop("o_orderkey"))


def raw_journal_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw journal lines (text columns, aliased names) plus fixture tags.

    Extra columns: ``ledger_source``, ``geo`` (region), ``geo_tag`` (nullable geo
    used by entry generation) and ``delivery`` (1, or 2 for a re-delivery).
    """
    joined = lake_table(spark, "joined-items", input_fingerprint(spark, sf_dir), lambda: _joined_items(spark, sf_dir))
    okey = F.col("l_orderkey")
    side_delivery = F.when(
        okey % 10 == 0,
        F.array(*[F.struct(F.lit(s).alias("side"), F.lit(d).alias("delivery"))
                  for d in (1, 2) for s in ("D", "C")]),
    ).otherwise(F.array(*[F.struct(F.lit(s).alias("side"), F.lit(1).alias("delivery"))
                          for s in ("D", "C")]))
    expanded = joined.select("*", F.inline(side_delivery))

    is_debit = F.col("side") == F.lit("D")
    price = F.col("l_extendedprice").cast(AMOUNT_TYPE)
    credit = F.when(okey % 13 == 0, price + F.lit(0.01).cast(AMOUNT_TYPE)).otherwise(price)
    ledger_source = _case(F.col("l_returnflag"), LEDGER_BY_RETURNFLAG)
    order_date = F.col("o_orderdate").cast("date")
    return expanded.select(
        F.concat(F.lit("J-"), okey.cast("string")).alias("journal_id"),
        (F.col("l_linenumber") * 2 - F.when(is_debit, 1).otherwise(0)).cast("string").alias("line_num"),
        F.concat(F.col("r_name"),
                 F.when(okey % 50 == 0, F.lit("-SECONDARY")).otherwise(F.lit("-PRIMARY"))).alias("ledger_id"),
        F.when(okey % 97 == 0, F.lit(None).cast("string"))
         .otherwise(order_date.cast("string")).alias("acct_date"),
        _case(F.col("r_name"), CURRENCY_BY_REGION, OTHER_CURRENCY).alias("currency_code"),
        F.when(is_debit, _amount_text(price)).alias("entered_dr"),
        F.when(~is_debit, _amount_text(price)).alias("entered_cr"),
        F.when(is_debit, _amount_text(price)).alias("accounted_dr"),
        F.when(~is_debit, _amount_text(credit)).alias("accounted_cr"),
        F.when(F.col("l_partkey") % 103 == 0, F.lit(None).cast("string"))
         .otherwise((F.col("n_nationkey") + 1).cast(RATE_TYPE).cast("string")).alias("fx_rate"),
        F.col("n_name").alias("segment1_entity"),
        F.col("c_mktsegment").alias("segment2_cost_center"),
        F.when(F.col("l_partkey") % 101 == 0, F.lit("")).otherwise(F.col("p_type")).alias("segment3_account"),
        F.col("o_orderpriority").alias("segment4_project"),
        F.concat(F.lit("S"), (F.col("l_suppkey") % 10).cast("string")).alias("segment5_intercompany"),
        F.col("p_brand").alias("segment6_product"),
        F.concat(F.lit("FX "), F.col("l_returnflag"), F.col("l_linestatus")).alias("description"),
        F.concat(F.lit("b"), F.year("o_orderdate").cast("string")).alias("batch_id"),
        ledger_source.alias("ledger_source"),
        F.col("r_name").alias("geo"),
        F.when((F.col("l_returnflag") != F.lit("A")) & (okey % 7 == 0), F.lit(None).cast("string"))
         .otherwise(F.col("r_name")).alias("geo_tag"),
        F.col("delivery"),
    )


FIXTURE_EXTRA = ["ledger_source", "geo", "geo_tag", "delivery"]


def source_system_of_ledger():
    return F.concat(F.col("ledger_source"), F.lit("_FX"))


def account_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segment reference values as (segment, value): every part type except MEDIUM accounts."""
    types = table(spark, sf_dir, "part").select(F.col("p_type").alias("value")).distinct()
    return (types.filter(F.col("value") != F.lit("MEDIUM"))
                 .select(F.lit("segment3_account").alias("segment"), "value"))


def trial_balance(raw_lines: DataFrame) -> DataFrame:
    """(geo, account, opening, activity) for every (region, account) seen in the
    first delivery, except the ``MEDIUM`` and blank accounts.

    Opening is 10 per line and activity 10 per journal of that (geo, account):
    an aggregate over the lines (partial, map-side), so it grows with the data.
    """
    first = raw_lines.filter((F.col("delivery") == 1)
                             & (F.col("segment3_account") != F.lit("MEDIUM"))
                             & (F.trim(F.col("segment3_account")) != F.lit("")))
    return (first.groupBy(F.col("geo"), F.col("segment3_account").alias("account"))
                 .agg((F.count(F.lit(1)) * 10).cast(AMOUNT_TYPE).alias("opening"),
                      (F.countDistinct("journal_id") * 10).cast(AMOUNT_TYPE).alias("activity")))


# Decisions and audit rows are derived from ``events``: each event targets the
# monthly entry batch of month ``user_id mod 84`` counted from January 1995.
DECISION_ACTION_BY_EVENT = {"click": "approve", "purchase": "APPROVE", "view": "Reject"}
AUDIT_STATUS_BY_EVENT = {"signup": "POSTED", "error": "FAILED"}
FIRST_MONTH = "1995-01-01"
MONTH_SPAN = 84


def _target_batch():
    month = F.add_months(F.lit(FIRST_MONTH).cast("date"), (F.col("user_id") % MONTH_SPAN).cast("int"))
    return F.concat(F.lit("je-monthly-"), F.last_day(month).cast("string"))


def approval_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(decision_id, approval_id, action, approver, decided_at) from events (S22 input)."""
    from fxlake.functions.scalar import stable_id

    ev = table(spark, sf_dir, "events")
    action = _case(F.col("event_type"), DECISION_ACTION_BY_EVENT)
    return ev.select(
        F.col("event_id").alias("decision_id"),
        stable_id("apr-", _target_batch(), length=16).alias("approval_id"),
        F.coalesce(action, F.col("event_type")).alias("action"),
        F.concat(F.lit("user-"), F.col("user_id").cast("string")).alias("approver"),
        F.col("ts").alias("decided_at"),
    )


def booking_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit rows of an earlier run: signup events POSTED, error events FAILED."""
    ev = table(spark, sf_dir, "events").filter(F.col("event_type").isin(list(AUDIT_STATUS_BY_EVENT)))
    return ev.select(
        F.concat(F.lit("run-"), F.col("event_id").cast("string")).alias("booking_run_id"),
        _target_batch().alias("journal_batch_id"),
        _case(F.col("event_type"), AUDIT_STATUS_BY_EVENT).alias("status"),
    )


def event_payloads(spark: SparkSession, sf_dir: str, keep: list[str] | None = None) -> DataFrame:
    """Events as stream input: base64 text of one JSON object per event (FIXTURES B4).

    Even event ids carry the account flat (``segment3_account``), odd ones nested
    (``account_segments.account``); the entity comes from the legacy field.
    """
    ev = spread_scan(table(spark, sf_dir, "events"))
    even = (F.col("event_id") % 2) == 0
    payload = F.to_json(F.struct(
        F.concat(F.lit("IC-"), F.col("user_id").cast("string")).alias("journal_id"),
        F.col("event_id").cast("string").alias("ledger_line_num"),
        F.lit("IC-PRIMARY").alias("ledger_id"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("effective_date"),
        F.lit("USD").alias("currency_code"),
        F.col("value").cast(AMOUNT_TYPE).cast("string").alias("entered_dr"),
        F.lit("1.00000000").alias("fx_rate"),
        F.when(even, F.col("event_type")).alias("segment3_account"),
        F.struct(F.when(~even, F.col("event_type")).alias("account"),
                 F.get_json_object("props", "$.k").alias("product")).alias("account_segments"),
        F.concat(F.lit("E"), (F.col("user_id") % 5).cast("string")).alias("legal_entity"),
    ))
    # One event per line: drop any line breaks a chunking base64 encoder inserts.
    return ev.select(F.regexp_replace(F.base64(F.encode(payload, "UTF-8")), r"\s+", "").alias("value"), *(keep or []))

"""Plain-SQL oracles (DuckDB dialect) for the query catalogue.

Each oracle re-derives its input from the driver tables with the same rules as
``fxlake.sources.fixture`` and computes the answer independently of the Spark
operators. The CTE blocks below are composed into one ``WITH`` per query.
"""

from __future__ import annotations

from fxlake.schema import PAYLOAD_COLUMNS

RUN_TS = "TIMESTAMP '2024-01-01 00:00:00'"

RAW = """
raw AS (
  SELECT
    'J-' || CAST(l.l_orderkey AS VARCHAR) AS journal_id,
    CAST(l.l_linenumber * 2 - CASE WHEN s.side = 'D' THEN 1 ELSE 0 END AS VARCHAR) AS line_num,
    r.r_name || CASE WHEN l.l_orderkey % 50 = 0 THEN '-SECONDARY' ELSE '-PRIMARY' END AS ledger_id,
    CASE WHEN l.l_orderkey % 97 = 0 THEN NULL
         ELSE CAST(CAST(o.o_orderdate AS DATE) AS VARCHAR) END AS acct_date,
    CASE r.r_name WHEN 'AFRICA' THEN 'ZAR' WHEN 'AMERICA' THEN 'USD' WHEN 'ASIA' THEN 'JPY'
                  WHEN 'EUROPE' THEN 'EUR' ELSE 'AED' END AS currency_code,
    CASE WHEN s.side = 'D' THEN CAST(CAST(l.l_extendedprice AS DECIMAL(20,4)) AS VARCHAR) END AS entered_dr,
    CASE WHEN s.side = 'C' THEN CAST(CAST(l.l_extendedprice AS DECIMAL(20,4)) AS VARCHAR) END AS entered_cr,
    CASE WHEN s.side = 'D' THEN CAST(CAST(l.l_extendedprice AS DECIMAL(20,4)) AS VARCHAR) END AS accounted_dr,
    CASE WHEN s.side = 'C' THEN CAST(CAST(
           CAST(l.l_extendedprice AS DECIMAL(20,4))
           + CASE WHEN l.l_orderkey % 13 = 0 THEN CAST(0.01 AS DECIMAL(20,4)) ELSE 0 END
         AS DECIMAL(20,4)) AS VARCHAR) END AS accounted_cr,
    CASE WHEN l.l_partkey % 103 = 0 THEN NULL
         ELSE CAST(CAST(n.n_nationkey + 1 AS DECIMAL(18,8)) AS VARCHAR) END AS fx_rate,
    n.n_name AS segment1_entity,
    c.c_mktsegment AS segment2_cost_center,
    CASE WHEN l.l_partkey % 101 = 0 THEN '' ELSE p.p_type END AS segment3_account,
    o.o_orderpriority AS segment4_project,
    'S' || CAST(l.l_suppkey % 10 AS VARCHAR) AS segment5_intercompany,
    p.p_brand AS segment6_product,
    'FX ' || l.l_returnflag || l.l_linestatus AS description,
    'b' || CAST(year(o.o_orderdate) AS VARCHAR) AS batch_id,
    CASE l.l_returnflag WHEN 'A' THEN 'AP' WHEN 'R' THEN 'AR' WHEN 'N' THEN 'IC' END AS ledger_source,
    r.r_name AS geo,
    CASE WHEN l.l_returnflag <> 'A' AND l.l_orderkey % 7 = 0 THEN NULL ELSE r.r_name END AS geo_tag,
    s.delivery
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN (VALUES ('D', 1), ('C', 1), ('D', 2), ('C', 2)) AS s(side, delivery)
    ON s.delivery = 1 OR l.l_orderkey % 10 = 0
)"""

_key_expr = (
    "md5(concat_ws('||', source_system, coalesce(CAST(journal_id AS VARCHAR), ''), "
    "coalesce(CAST(journal_line_num AS VARCHAR), ''), coalesce(CAST(effective_date AS VARCHAR), ''), "
    "coalesce(CAST(entered_dr AS VARCHAR), '0')))"
)
_hash_expr = "sha256(concat_ws('||', " + ", ".join(
    f"coalesce(CAST({c} AS VARCHAR), '')" for c in PAYLOAD_COLUMNS) + "))"

CANON = f"""
canon0 AS (
  SELECT
    ledger_source || '_FX' AS source_system,
    journal_id,
    TRY_CAST(line_num AS INTEGER) AS journal_line_num,
    ledger_id,
    TRY_CAST(acct_date AS DATE) AS effective_date,
    currency_code,
    TRY_CAST(entered_dr AS DECIMAL(20,4)) AS entered_dr,
    TRY_CAST(entered_cr AS DECIMAL(20,4)) AS entered_cr,
    TRY_CAST(accounted_dr AS DECIMAL(20,4)) AS accounted_dr,
    TRY_CAST(accounted_cr AS DECIMAL(20,4)) AS accounted_cr,
    TRY_CAST(fx_rate AS DECIMAL(18,8)) AS fx_rate,
    segment1_entity, segment2_cost_center, segment3_account, segment4_project,
    segment5_intercompany, segment6_product,
    '000' AS segment7_spare,
    coalesce(description, '') AS description,
    batch_id,
    {RUN_TS} AS load_timestamp,
    ledger_source, geo, geo_tag, delivery
  FROM raw
),
canon1 AS (
  SELECT *, upper(strftime(effective_date, '%b-%Y')) AS period_name FROM canon0
),
canon AS (
  SELECT *, {_key_expr} AS surrogate_key, {_hash_expr} AS payload_hash FROM canon1
)"""

NULL_CHECK_COLUMNS = [
    "surrogate_key", "source_system", "journal_id", "journal_line_num",
    "ledger_id", "effective_date", "period_name", "currency_code", "fx_rate",
    "segment1_entity", "segment2_cost_center", "segment3_account",
    "segment4_project", "segment5_intercompany", "segment6_product",
    "segment7_spare", "description", "batch_id", "load_timestamp", "payload_hash",
]

_reasons = "concat_ws(',', " + ", ".join(
    f"CASE WHEN {c} IS NULL THEN '{c}' END" for c in NULL_CHECK_COLUMNS) + ")"

VALID = f"""
classified AS (
  SELECT *, {_reasons} AS quarantine_reason FROM canon
),
valid AS (
  SELECT * EXCLUDE (quarantine_reason) FROM classified WHERE quarantine_reason = ''
)"""

# One row per surrogate key: smallest payload hash, then delivery.
DEDUP = """
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY surrogate_key ORDER BY payload_hash, delivery) AS rn
  FROM valid
),
dedup AS (
  SELECT * EXCLUDE (rn) FROM ranked WHERE rn = 1
)"""


def with_ctes(*blocks: str, body: str) -> str:
    return "WITH " + ",".join(blocks) + "\n" + body

"""Oracle SQL (DuckDB) for each query of the catalogue."""

from __future__ import annotations

from fxlake.plans.oracle_sql import CANON, DEDUP, RAW, VALID, with_ctes
from fxlake.schema import CANONICAL_COLUMNS, NON_NULLABLE_COLUMNS, SEGMENT_COLUMNS

LINE_COLUMNS_SQL = """surrogate_key, source_system, journal_id, journal_line_num, ledger_id,
  effective_date, period_name, currency_code, entered_dr, entered_cr, accounted_dr, accounted_cr,
  fx_rate, segment1_entity, segment2_cost_center, segment3_account, segment4_project,
  segment5_intercompany, segment6_product, segment7_spare, description, batch_id, payload_hash,
  delivery"""

BASE = (RAW, CANON)
SILVER = (RAW, CANON, VALID, DEDUP)

_business_hash = "sha256(concat_ws('||', " + ", ".join(
    f"coalesce(CAST({c} AS VARCHAR), '')" for c in [
        "journal_id", "journal_line_num", "ledger_id", "effective_date",
        "period_name", "currency_code", "entered_dr", "entered_cr",
        "accounted_dr", "accounted_cr", "fx_rate",
        "segment1_entity", "segment2_cost_center", "segment3_account",
        "segment4_project", "segment5_intercompany", "segment6_product",
        "segment7_spare", "description"]) + "))"


def _blank_list(columns: list[str]) -> str:
    return "concat_ws(',', " + ", ".join(
        f"CASE WHEN {c} IS NULL OR trim(CAST({c} AS VARCHAR)) = '' THEN '{c}' END"
        for c in columns) + ")"


_unbalanced = """
  SELECT batch_id, coalesce(journal_id, 'UNKNOWN') AS journal_id,
         CAST(sum(coalesce(accounted_dr, 0)) AS DECIMAL(38,4)) AS accounted_dr,
         CAST(sum(coalesce(accounted_cr, 0)) AS DECIMAL(38,4)) AS accounted_cr
  FROM {src} GROUP BY 1, 2
  HAVING sum(coalesce(accounted_dr, 0)) <> sum(coalesce(accounted_cr, 0))"""

ACCOUNT_REF = """
ref AS (
  SELECT DISTINCT 'segment3_account' AS segment, p_type AS value FROM part WHERE p_type <> 'MEDIUM'
)"""

SEG_VIOL = ACCOUNT_REF + """,
segvals AS (
  UNPIVOT (SELECT batch_id, journal_id, journal_line_num, """ + ", ".join(SEGMENT_COLUMNS) + """ FROM dedup)
  ON """ + ", ".join(SEGMENT_COLUMNS) + """ INTO NAME segment VALUE value
),
segviol AS (
  SELECT batch_id, journal_id, journal_line_num, segment, '<empty>' AS value
  FROM segvals WHERE value IS NULL OR trim(value) = ''
  UNION ALL
  SELECT s.batch_id, s.journal_id, s.journal_line_num, s.segment, s.value
  FROM segvals s
  WHERE NOT (s.value IS NULL OR trim(s.value) = '')
    AND s.segment IN (SELECT segment FROM ref)
    AND NOT EXISTS (SELECT 1 FROM ref r WHERE r.segment = s.segment AND r.value = s.value)
)"""

NULL_VIOL = """
nullviol AS (
  SELECT batch_id, journal_id, journal_line_num, """ + _blank_list(NON_NULLABLE_COLUMNS) + """ AS columns
  FROM dedup
),
nullviol2 AS (SELECT * FROM nullviol WHERE columns <> '')"""

UNBAL = """
unbal AS (""" + _unbalanced.format(src="dedup") + """
)"""

MEC_SUMMARY = with_ctes(*SILVER, SEG_VIOL, NULL_VIOL, UNBAL, """
counts AS (
  SELECT d.batch_id, count(*) AS n_lines FROM dedup d GROUP BY 1
),
per AS (
  SELECT c.batch_id, c.n_lines,
    (SELECT count(*) FROM nullviol2 x WHERE x.batch_id = c.batch_id) AS n_completeness_issues,
    (SELECT count(*) FROM unbal x WHERE x.batch_id = c.batch_id) AS n_balance_issues,
    (SELECT count(*) FROM segviol x WHERE x.batch_id = c.batch_id) AS n_segment_issues
  FROM counts c
),
f AS (
  SELECT *, CAST(n_completeness_issues > 0 OR n_lines = 0 AS INTEGER)
          + CAST(n_balance_issues > 0 AS INTEGER) + CAST(n_segment_issues > 0 AS INTEGER) AS failed
  FROM per
)""", body="""
SELECT batch_id, n_lines, 3 AS checks_run, 3 - failed AS checks_passed, failed AS checks_failed,
       failed = 0 AS is_valid,
       CASE WHEN n_lines = 0 THEN 'no_journal_lines' END AS empty_reason,
       n_completeness_issues, n_balance_issues, n_segment_issues
FROM f""")

ORACLES = {
    "canonical_lines": with_ctes(*BASE, body=f"SELECT {LINE_COLUMNS_SQL} FROM canon"),
    "surrogate_keys": with_ctes(*BASE, body="""
SELECT surrogate_key, count(*) AS n_rows, count(DISTINCT payload_hash) AS n_payloads
FROM canon GROUP BY surrogate_key"""),
    "payload_hashes": with_ctes(*BASE, body=f"""
SELECT payload_hash, {_business_hash} AS business_hash, count(*) AS n_rows
FROM canon GROUP BY 1, 2"""),
    "quarantine_split": with_ctes(*BASE, VALID, body="""
SELECT batch_id, journal_id, journal_line_num, source_system, surrogate_key, delivery, quarantine_reason
FROM classified WHERE quarantine_reason <> ''"""),
    "dedup_lines": with_ctes(*SILVER, body=f"SELECT {LINE_COLUMNS_SQL} FROM dedup"),
    "duplicate_keys": with_ctes(*BASE, VALID, body="""
SELECT coalesce(surrogate_key, '') AS surrogate_key, count(*) AS occurrences
FROM valid GROUP BY 1 HAVING count(*) > 1"""),
    "raw_unbalanced_journals": with_ctes(*BASE, body=_unbalanced.format(src="canon")),
    "mec_unbalanced_journals": with_ctes(*SILVER, body=_unbalanced.format(src="dedup")),
    "mec_missing_values": with_ctes(*SILVER, NULL_VIOL, body="SELECT * FROM nullviol2"),
    "mec_segment_violations": with_ctes(*SILVER, SEG_VIOL, body="""
SELECT batch_id, segment, value, count(*) AS n_lines FROM segviol GROUP BY 1, 2, 3"""),
    "mec_summary": MEC_SUMMARY,
}


# ---------------------------------------------------------------------------
# Trial-balance gate on Silver
# ---------------------------------------------------------------------------

FIXTURE_GEOS_SQL = "('AFRICA'), ('AMERICA'), ('ASIA'), ('EUROPE'), ('MIDDLE EAST'), ('ANTARCTICA')"

TB_TABLE = """
tb AS (
  SELECT geo, segment3_account AS account,
         CAST(count(*) * 10 AS DECIMAL(20,4)) AS opening,
         CAST(count(DISTINCT journal_id) * 10 AS DECIMAL(20,4)) AS activity
  FROM raw
  WHERE delivery = 1 AND segment3_account <> 'MEDIUM' AND trim(segment3_account) <> ''
  GROUP BY 1, 2
)"""

TB_CHECKS = TB_TABLE + """,
fgeos AS (SELECT * FROM (VALUES """ + FIXTURE_GEOS_SQL + """) t(geo)),
tb_unbal AS (
  SELECT batch_id, coalesce(geo, 'UNKNOWN') AS geo, coalesce(ledger_source, 'UNKNOWN') AS ledger_source,
         CAST(sum(coalesce(accounted_dr, 0)) AS DECIMAL(38,4)) AS accounted_dr,
         CAST(sum(coalesce(accounted_cr, 0)) AS DECIMAL(38,4)) AS accounted_cr,
         CAST(sum(coalesce(accounted_dr, 0)) - sum(coalesce(accounted_cr, 0)) AS DECIMAL(38,4)) AS diff
  FROM dedup GROUP BY 1, 2, 3
  HAVING sum(coalesce(accounted_dr, 0)) <> sum(coalesce(accounted_cr, 0))
),
tb_unknown AS (
  SELECT d.batch_id, d.geo, d.segment3_account AS account, d.journal_id, d.journal_line_num
  FROM dedup d
  WHERE d.segment3_account IS NOT NULL AND d.segment3_account <> ''
    AND d.geo IN (SELECT geo FROM tb)
    AND NOT EXISTS (SELECT 1 FROM tb t WHERE t.geo = d.geo AND t.account = d.segment3_account)
),
tb_missing AS (
  SELECT b.batch_id, g.geo
  FROM (SELECT DISTINCT batch_id FROM dedup) b, fgeos g
  WHERE NOT EXISTS (SELECT 1 FROM dedup d WHERE d.batch_id = b.batch_id AND d.geo = g.geo)
),
tb_net AS (
  SELECT n.geo, n.account, n.batch_id, n.net_movement, CAST(t.opening + t.activity AS DECIMAL(38,4)) AS "limit"
  FROM (SELECT batch_id, geo, segment3_account AS account,
               CAST(abs(sum(coalesce(accounted_dr, 0)) - sum(coalesce(accounted_cr, 0))) AS DECIMAL(38,4)) AS net_movement
        FROM dedup GROUP BY 1, 2, 3) n
  JOIN tb t ON t.geo = n.geo AND t.account = n.account
  WHERE n.net_movement > CAST(t.opening + t.activity AS DECIMAL(38,4))
)"""

TB_SUMMARY_BODY = """
SELECT batch_id, n_unbalanced, n_unknown_accounts, n_missing_geos, n_net_movement,
       n_unbalanced + n_unknown_accounts + CAST(n_missing_geos > 0 AS BIGINT) + n_net_movement AS issue_count,
       n_unbalanced + n_unknown_accounts + CAST(n_missing_geos > 0 AS BIGINT) + n_net_movement = 0 AS is_valid
FROM (
  SELECT b.batch_id,
    (SELECT count(*) FROM tb_unbal x WHERE x.batch_id = b.batch_id) AS n_unbalanced,
    (SELECT count(*) FROM tb_unknown x WHERE x.batch_id = b.batch_id) AS n_unknown_accounts,
    (SELECT count(*) FROM tb_missing x WHERE x.batch_id = b.batch_id) AS n_missing_geos,
    (SELECT count(*) FROM tb_net x WHERE x.batch_id = b.batch_id) AS n_net_movement
  FROM (SELECT DISTINCT batch_id FROM dedup) b
)"""

ORACLES.update({
    "tb_unbalanced_geo_source": with_ctes(*SILVER, TB_CHECKS, body="SELECT * FROM tb_unbal"),
    "tb_unknown_accounts": with_ctes(*SILVER, TB_CHECKS, body="SELECT * FROM tb_unknown"),
    "tb_missing_geos": with_ctes(*SILVER, TB_CHECKS, body="SELECT * FROM tb_missing"),
    "tb_net_movement": with_ctes(*SILVER, TB_CHECKS, body="SELECT * FROM tb_net"),
    "tb_summary": with_ctes(*SILVER, TB_CHECKS, body=TB_SUMMARY_BODY),
})


# ---------------------------------------------------------------------------
# Entry generation (all periods at once), booking aggregates
# ---------------------------------------------------------------------------

_PERIOD_MONTHS = {"MONTHLY": 1, "QUARTERLY": 3, "YEARLY": 12}


def entries_cte(period_type: str) -> str:
    n = _PERIOD_MONTHS.get(period_type, 1)
    p = period_type.lower()
    ent_key = _key_expr_sql()
    ent_hash = _hash_expr_sql()
    return f"""
esrc AS (
  SELECT * EXCLUDE (batch_id, geo),
    last_day(make_date(CAST(year(effective_date) AS INTEGER),
                       CAST(((month(effective_date) - 1) // {n}) * {n} + {n} AS INTEGER), 1)) AS period_end
  FROM dedup WHERE ledger_source IN ('AP', 'AR', 'IC')
),
esrc2 AS (SELECT *, 'je-{p}-' || CAST(period_end AS VARCHAR) AS batch_id FROM esrc),
egeos AS (SELECT * FROM (VALUES {FIXTURE_GEOS_SQL}) t(geo)),
matched AS (
  SELECT s.*, g.geo, false AS is_fallback FROM esrc2 s JOIN egeos g ON s.geo_tag IS NULL OR s.geo_tag = g.geo
),
srcpairs AS (SELECT DISTINCT batch_id, ledger_source FROM esrc2),
missingpairs AS (
  SELECT p.batch_id, p.ledger_source, g.geo FROM srcpairs p, egeos g
  WHERE NOT EXISTS (SELECT 1 FROM matched m
                    WHERE m.batch_id = p.batch_id AND m.ledger_source = p.ledger_source AND m.geo = g.geo)
),
fallback AS (
  SELECT s.*, m.geo, true AS is_fallback FROM esrc2 s
  JOIN missingpairs m ON s.batch_id = m.batch_id AND s.ledger_source = m.ledger_source
),
assigned AS (SELECT * FROM matched UNION ALL BY NAME SELECT * FROM fallback),
numbered AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY batch_id, ledger_source, geo
                                    ORDER BY journal_id, journal_line_num, surrogate_key) AS INTEGER) AS eline
  FROM assigned
),
ent0 AS (
  SELECT batch_id, ledger_source, geo, is_fallback,
    ledger_source || '_FX' AS source_system,
    journal_id, eline AS journal_line_num,
    coalesce(ledger_id, geo || '-PRIMARY') AS ledger_id,
    period_end AS effective_date,
    upper(strftime(period_end, '%b-%Y')) AS period_name,
    coalesce(currency_code, 'USD') AS currency_code,
    coalesce(entered_dr, CAST(0 AS DECIMAL(20,4))) AS entered_dr,
    coalesce(entered_cr, CAST(0 AS DECIMAL(20,4))) AS entered_cr,
    coalesce(accounted_dr, entered_dr, CAST(0 AS DECIMAL(20,4))) AS accounted_dr,
    coalesce(accounted_cr, entered_cr, CAST(0 AS DECIMAL(20,4))) AS accounted_cr,
    coalesce(fx_rate, CAST('1.00000000' AS DECIMAL(18,8))) AS fx_rate,
    coalesce(segment1_entity, geo) AS segment1_entity,
    coalesce(segment2_cost_center, 'DEFAULT') AS segment2_cost_center,
    coalesce(segment3_account, '') AS segment3_account,
    coalesce(segment4_project, 'NONE') AS segment4_project,
    coalesce(segment5_intercompany, '000') AS segment5_intercompany,
    coalesce(segment6_product, 'GENERAL') AS segment6_product,
    coalesce(segment7_spare, '000') AS segment7_spare,
    coalesce(description, ledger_source || ' FX adjustment — ' || geo) AS description,
    '{period_type}' AS period_type,
    TIMESTAMP '2024-01-01 00:00:00' AS load_timestamp
  FROM numbered
),
entries AS (
  SELECT *, {ent_key} AS surrogate_key, {ent_hash} AS payload_hash FROM ent0
)"""


def _key_expr_sql() -> str:
    from fxlake.plans.oracle_sql import _key_expr
    return _key_expr


def _hash_expr_sql() -> str:
    from fxlake.plans.oracle_sql import _hash_expr
    return _hash_expr


ENTRY_OUT_SQL = """batch_id, ledger_source, geo, is_fallback, source_system, journal_id, journal_line_num,
  ledger_id, effective_date, period_name, currency_code, entered_dr, entered_cr, accounted_dr,
  accounted_cr, fx_rate, segment1_entity, segment2_cost_center, segment3_account, segment4_project,
  segment5_intercompany, segment6_product, segment7_spare, description, surrogate_key, payload_hash"""

ENTRY_COLS = ["source_system", "journal_id", "journal_line_num", "ledger_id", "effective_date",
              "period_name", "currency_code", "entered_dr", "entered_cr", "accounted_dr", "accounted_cr",
              "fx_rate", "segment1_entity", "segment2_cost_center", "segment3_account", "segment4_project",
              "segment5_intercompany", "segment6_product", "segment7_spare", "description", "batch_id",
              "geo", "ledger_source", "period_type"]
AMOUNTS = ["accounted_dr", "accounted_cr", "entered_dr", "entered_cr"]


def _group_keys(period_type: str) -> list[str]:
    if period_type == "QUARTERLY":
        return ["geo", "journal_id", "segment3_account"]
    if period_type == "YEARLY":
        return ["geo", "segment3_account"]
    return ["journal_id"]


def book_sql(period_type: str) -> str:
    keys = _group_keys(period_type)
    allk = ["batch_id", *keys]
    tmpl_cols = [c for c in ENTRY_COLS if c not in allk and c not in AMOUNTS
                 and c not in ("journal_line_num", "description")]
    on = " AND ".join(f"t.{k} = b.{k}" for k in allk)
    geo_ref = "b.geo" if "geo" in keys else "t.geo"
    sums = ", ".join(f"CAST(sum(coalesce({a}, 0)) AS DECIMAL(38,4)) AS {a}" for a in AMOUNTS)
    return with_ctes(*SILVER, entries_cte(period_type), f"""
bk AS (
  SELECT {", ".join(allk)}, {sums}, count(*) AS n_entries FROM entries GROUP BY {", ".join(allk)}
),
tmpl AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY {", ".join(allk)} ORDER BY ledger_source, geo, journal_line_num) AS trn
    FROM entries) WHERE trn = 1
),
bk2 AS (
  SELECT b.*, {", ".join("t." + c for c in tmpl_cols)},
    CAST(row_number() OVER (PARTITION BY b.batch_id ORDER BY {", ".join("b." + k for k in keys)}) AS INTEGER)
      AS journal_line_num,
    '{period_type} FX adjustment — ' || coalesce({geo_ref}, '') AS description
  FROM bk b JOIN tmpl t ON {on}
),
bk3 AS (
  SELECT *, {_key_expr_sql()} AS surrogate_key, {_hash_expr_sql()} AS payload_hash FROM bk2
)""", body="""
SELECT batch_id, geo, journal_id, segment3_account, ledger_source, journal_line_num,
       accounted_dr, accounted_cr, entered_dr, entered_cr, n_entries, description, surrogate_key, payload_hash
FROM bk3""")


MONTHLY = (*SILVER, entries_cte("MONTHLY"))

APPROVAL = """
reqs AS (
  SELECT batch_id, 'apr-' || substr(md5(batch_id), 1, 16) AS approval_id FROM entries GROUP BY batch_id
),
decisions AS (
  SELECT event_id AS decision_id,
    'apr-' || substr(md5('je-monthly-' || CAST(last_day(CAST(DATE '1995-01-01'
        + to_months(CAST(user_id % 84 AS INTEGER)) AS DATE)) AS VARCHAR)), 1, 16) AS approval_id,
    upper(CASE event_type WHEN 'click' THEN 'approve' WHEN 'purchase' THEN 'APPROVE'
                          WHEN 'view' THEN 'Reject' ELSE event_type END) AS action,
    'user-' || CAST(user_id AS VARCHAR) AS approver,
    ts AS decided_at
  FROM events
),
accepted AS (
  SELECT d.*, r.batch_id FROM decisions d JOIN reqs r ON d.approval_id = r.approval_id
  WHERE d.action IN ('APPROVE', 'REJECT')
),
rejected AS (
  SELECT decision_id, approval_id, action, 'invalid_action' AS reason FROM decisions
  WHERE action NOT IN ('APPROVE', 'REJECT')
  UNION ALL
  SELECT decision_id, approval_id, action, 'unknown_approval' AS reason FROM decisions d
  WHERE action IN ('APPROVE', 'REJECT') AND approval_id NOT IN (SELECT approval_id FROM reqs)
),
firstdec AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY approval_id ORDER BY decided_at, decision_id) AS rn,
              count(*) OVER (PARTITION BY approval_id) AS n_valid_decisions
    FROM accepted) WHERE rn = 1
),
astate AS (
  SELECT r.approval_id, r.batch_id,
    CASE f.action WHEN 'APPROVE' THEN 'APPROVED' WHEN 'REJECT' THEN 'REJECTED' ELSE 'PENDING' END AS status,
    coalesce(f.approver, '') AS approved_by, f.decision_id,
    coalesce(f.n_valid_decisions, 0) AS n_valid_decisions
  FROM reqs r LEFT JOIN firstdec f ON r.approval_id = f.approval_id
)"""


def _seg_viol(src: str) -> str:
    return SEG_VIOL.replace("FROM dedup)", f"FROM {src})").replace("segvals", f"segvals_{src}").replace(
        "segviol", f"segviol_{src}").replace("ref AS", f"ref_{src} AS").replace("FROM ref", f"FROM ref_{src}")


def _mec_valid(src: str) -> str:
    return _seg_viol(src) + f""",
mec_{src} AS (
  SELECT b.batch_id,
    NOT EXISTS (SELECT 1 FROM {src} x WHERE x.batch_id = b.batch_id AND {_blank_list(NON_NULLABLE_COLUMNS)} <> '')
    AND NOT EXISTS (SELECT 1 FROM ({_unbalanced.format(src=src)}) u WHERE u.batch_id = b.batch_id)
    AND NOT EXISTS (SELECT 1 FROM segviol_{src} s WHERE s.batch_id = b.batch_id) AS is_valid
  FROM (SELECT DISTINCT batch_id FROM {src}) b
)"""


BOOKING_STATUS = with_ctes(*MONTHLY, APPROVAL, _mec_valid("entries"), """
audit AS (
  SELECT 'je-monthly-' || CAST(last_day(CAST(DATE '1995-01-01' + to_months(CAST(user_id % 84 AS INTEGER)) AS DATE))
         AS VARCHAR) AS journal_batch_id,
         CASE event_type WHEN 'signup' THEN 'POSTED' WHEN 'error' THEN 'FAILED' END AS status
  FROM events WHERE event_type IN ('signup', 'error')
),
st AS (
  SELECT b.batch_id, coalesce(m.is_valid, false) AS is_valid,
    coalesce(a.status, 'PENDING') AS approval_status,
    EXISTS (SELECT 1 FROM audit x WHERE x.journal_batch_id = b.batch_id AND x.status = 'POSTED') AS already,
    b.line_count
  FROM (SELECT batch_id, count(*) AS line_count FROM entries GROUP BY batch_id) b
  LEFT JOIN mec_entries m ON m.batch_id = b.batch_id
  LEFT JOIN astate a ON a.batch_id = b.batch_id
),
st2 AS (
  SELECT *, CASE WHEN NOT is_valid THEN 'BLOCKED_VALIDATION'
                 WHEN approval_status <> 'APPROVED' THEN 'NOT_APPROVED'
                 WHEN already THEN 'ALREADY_BOOKED' ELSE 'POSTED' END AS status
  FROM st
)""", body="""
SELECT batch_id, is_valid, approval_status, status,
  CASE WHEN status = 'POSTED' THEN 'OFA-MON-' || substr(batch_id, 1, 8) || '-' || upper(substr(md5(batch_id), 1, 6)) END
    AS ofa_journal_ref,
  CASE WHEN status = 'POSTED' THEN line_count END AS line_count
FROM st2""")

ORACLES.update({
    "je_entries": with_ctes(*MONTHLY, body=f"SELECT {ENTRY_OUT_SQL} FROM entries"),
    "je_fanout": with_ctes(*MONTHLY, body="""
SELECT batch_id, ledger_source, geo, is_fallback, count(*) AS n_lines FROM entries GROUP BY 1, 2, 3, 4"""),
    "batch_profile": with_ctes(*MONTHLY, body="""
SELECT batch_id, count(*) AS je_count,
  array_to_string(list_sort(list_distinct(list(geo))), ',') AS geos,
  array_to_string(list_sort(list_distinct(list(ledger_source))), ',') AS ledger_sources,
  count(*) FILTER (WHERE is_fallback) AS n_fallback
FROM entries GROUP BY batch_id"""),
    "book_monthly": with_ctes(*MONTHLY, body="""
SELECT batch_id, count(*) AS line_count,
  CAST(sum(accounted_dr) AS DECIMAL(38,4)) AS accounted_dr, CAST(sum(accounted_cr) AS DECIMAL(38,4)) AS accounted_cr
FROM entries GROUP BY batch_id"""),
    "book_quarterly": book_sql("QUARTERLY"),
    "book_yearly": book_sql("YEARLY"),
    "book_by_journal": book_sql("ADJUSTMENT"),
    "approval_checks": with_ctes(*MONTHLY, body="""
SELECT batch_id, je_count, n_not_primary, n_missing_hash, n_negative_amounts, n_duplicate_keys,
  n_missing_columns,
  n_not_primary + n_missing_hash + n_negative_amounts + n_duplicate_keys + n_missing_columns AS issue_count
FROM (
  SELECT batch_id, count(*) AS je_count,
    count(*) FILTER (WHERE NOT ends_with(coalesce(ledger_id, ''), '-PRIMARY')) AS n_not_primary,
    count(*) FILTER (WHERE payload_hash IS NULL OR payload_hash = '') AS n_missing_hash,
    count(*) FILTER (WHERE coalesce(entered_dr, 0) < 0 OR coalesce(entered_cr, 0) < 0
                        OR coalesce(accounted_dr, 0) < 0 OR coalesce(accounted_cr, 0) < 0) AS n_negative_amounts,
    count(*) - count(DISTINCT coalesce(surrogate_key, '')) AS n_duplicate_keys,
    CAST(0 AS BIGINT) AS n_missing_columns
  FROM entries GROUP BY batch_id)"""),
    "approval_state": with_ctes(*MONTHLY, APPROVAL, body="SELECT * FROM astate"),
    "approval_rejected_decisions": with_ctes(*MONTHLY, APPROVAL, body="SELECT * FROM rejected"),
    "booking_status": BOOKING_STATUS,
    "idempotent_ingest": with_ctes(*BASE, VALID, """
reg AS (SELECT DISTINCT surrogate_key FROM valid WHERE batch_id = (SELECT min(batch_id) FROM valid)),
acc AS (
  SELECT batch_id, count(DISTINCT surrogate_key) AS accepted FROM valid
  WHERE surrogate_key NOT IN (SELECT surrogate_key FROM reg) GROUP BY batch_id
),
inc AS (SELECT batch_id, count(*) AS incoming FROM valid GROUP BY batch_id)""", body="""
SELECT i.batch_id, coalesce(a.accepted, 0) AS accepted, i.incoming - coalesce(a.accepted, 0) AS skipped
FROM inc i LEFT JOIN acc a ON a.batch_id = i.batch_id"""),
})


# ---------------------------------------------------------------------------
# File round trips and the event stream
# ---------------------------------------------------------------------------

_STREAM_KEY = ("md5(concat_ws('||', 'ICO_FX', journal_id, coalesce(CAST(journal_line_num AS VARCHAR), ''), "
               "coalesce(CAST(effective_date AS VARCHAR), ''), coalesce(CAST(entered_dr AS VARCHAR), '0')))")

STREAM_ROWS = f"""
ev0 AS (
  SELECT 'ICO_FX' AS source_system,
    'IC-' || CAST(user_id AS VARCHAR) AS journal_id,
    CAST(event_id AS INTEGER) AS journal_line_num,
    'IC-PRIMARY' AS ledger_id,
    CAST(ts AS DATE) AS effective_date,
    upper(strftime(CAST(ts AS DATE), '%b-%Y')) AS period_name,
    'USD' AS currency_code,
    CAST(value AS DECIMAL(20,4)) AS entered_dr,
    CAST(NULL AS DECIMAL(20,4)) AS entered_cr,
    CAST(NULL AS DECIMAL(20,4)) AS accounted_dr,
    CAST(NULL AS DECIMAL(20,4)) AS accounted_cr,
    CAST('1.00000000' AS DECIMAL(18,8)) AS fx_rate,
    'E' || CAST(user_id % 5 AS VARCHAR) AS segment1_entity,
    CAST(NULL AS VARCHAR) AS segment2_cost_center,
    event_type AS segment3_account,
    CAST(NULL AS VARCHAR) AS segment4_project,
    CAST(NULL AS VARCHAR) AS segment5_intercompany,
    json_extract_string(props, '$.k') AS segment6_product,
    '000' AS segment7_spare,
    '' AS description,
    'ico-stream-20240101' AS batch_id
  FROM events
),
ev AS (
  SELECT *, {_STREAM_KEY} AS surrogate_key, {_hash_expr_sql()} AS payload_hash FROM ev0
)"""

ORACLES.update({
    "roundtrip_csv": ORACLES["dedup_lines"],
    "roundtrip_json_wrapped": ORACLES["quarantine_split"],
    "stream_bronze": with_ctes(STREAM_ROWS, body="""
SELECT surrogate_key, source_system, journal_id, journal_line_num, ledger_id, effective_date, period_name,
  currency_code, entered_dr, entered_cr, accounted_dr, accounted_cr, fx_rate, segment1_entity,
  segment2_cost_center, segment3_account, segment4_project, segment5_intercompany, segment6_product,
  segment7_spare, description, batch_id, payload_hash
FROM ev"""),
    "stream_replay": with_ctes(STREAM_ROWS, body="""
SELECT CAST(0 AS BIGINT) AS epoch, count(DISTINCT surrogate_key) AS accepted,
       count(*) - count(DISTINCT surrogate_key) AS skipped, CAST(0 AS BIGINT) AS corrupt FROM ev
UNION ALL SELECT CAST(1 AS BIGINT), CAST(0 AS BIGINT), CAST(0 AS BIGINT), CAST(1 AS BIGINT)
UNION ALL SELECT CAST(2 AS BIGINT), CAST(0 AS BIGINT), count(*), CAST(0 AS BIGINT) FROM ev"""),
})

def _crash_sql() -> str:
    """Counters of events dropped part by part; a key counts for the first part that holds it."""
    parts = {0: "event_id % 3 = 0", 1: "event_id % 3 < 2", 3: "event_id % 2 = 0"}
    held = " UNION ALL ".join(f"SELECT CAST({k} AS BIGINT) AS epoch, surrogate_key FROM (SELECT surrogate_key, journal_line_num AS event_id FROM ev) WHERE {w}"
                              for k, w in parts.items())
    return f"""
SELECT epoch, count(DISTINCT surrogate_key) FILTER (epoch = first) AS accepted,
       count(*) - count(DISTINCT surrogate_key) FILTER (epoch = first) AS skipped, CAST(0 AS BIGINT) AS corrupt
FROM (SELECT *, min(epoch) OVER (PARTITION BY surrogate_key) AS first FROM ({held})) GROUP BY epoch
UNION ALL SELECT CAST(2 AS BIGINT), CAST(0 AS BIGINT), CAST(0 AS BIGINT), CAST(1 AS BIGINT)"""


ORACLES.update({
    "stream_crash": with_ctes(STREAM_ROWS, body=_crash_sql()),
    "stream_dead_letters": with_ctes(STREAM_ROWS, body="""
SELECT '!' || CAST(journal_line_num AS VARCHAR) AS value, count(*) AS n FROM ev WHERE journal_line_num % 5 = 0 GROUP BY 1
UNION ALL SELECT 'bronze', count(DISTINCT surrogate_key) FROM ev WHERE journal_line_num % 5 <> 0"""),
    "stream_watermark": ORACLES["stream_bronze"],
})

ORACLES["gold_batches"] = with_ctes(*SILVER, body="""
SELECT batch_id, count(*) AS n_lines, count(*) AS n_stamped,
  CAST(sum(coalesce(accounted_dr, 0)) AS DECIMAL(38,4)) AS accounted_dr,
  CAST(sum(coalesce(accounted_cr, 0)) AS DECIMAL(38,4)) AS accounted_cr
FROM dedup GROUP BY batch_id""")


# ---------------------------------------------------------------------------
# File ingestion, amounts, reruns, issue rows
# ---------------------------------------------------------------------------

_AR_CANON = CANON.replace("ledger_source || '_FX' AS source_system", "'AR_FX' AS source_system")
_COLUMNS = ", ".join(c for c in CANONICAL_COLUMNS if c != "load_timestamp")
_ORDER_KEY = "CAST(substr(journal_id, 3) AS BIGINT)"
_SHAPES = _AR_CANON.replace("batch_id,\n    TIMESTAMP", f"""['bare', 'journal_lines', 'records', 'lines', 'csv_a', 'csv_b'][{_ORDER_KEY} % 6 + 1] AS batch_id,
    TIMESTAMP""")

_BATCH_DEDUP = """
branked AS (SELECT *, row_number() OVER (PARTITION BY batch_id, surrogate_key ORDER BY payload_hash) AS rn FROM valid),
bsilver AS (SELECT * EXCLUDE (rn) FROM branked WHERE rn = 1)"""

_EDGES = f"""
edges AS (
  SELECT batch_id, CASE {_ORDER_KEY} % 11 WHEN 0 THEN '1234567890123456' || accounted_dr WHEN 1 THEN accounted_dr || '7'
    WHEN 2 THEN 'x' || accounted_dr WHEN 3 THEN ' ' ELSE accounted_dr END AS a FROM raw
),
typed AS (SELECT batch_id, trim(a) AS a, TRY_CAST(trim(a) AS DECIMAL(38,10)) AS wide, TRY_CAST(trim(a) AS DECIMAL(20,4)) AS kept FROM edges)"""


def _issue(batch: str, check: str, kind: str, journal: str, line: str, column: str, detail: str, source: str) -> str:
    return (f'SELECT {batch} AS batch_id, {check} AS "check", {kind} AS issue_type, {journal} AS journal_id, '
            f'{line} AS journal_line_num, {column} AS "column", {detail} AS detail FROM {source}')


_NO_LINE = ("CAST(NULL AS VARCHAR)", "CAST(NULL AS INTEGER)")
_text = "CAST({} AS VARCHAR)".format

TB_ISSUES = " UNION ALL ".join([
    _issue("batch_id", "'n_unbalanced'", "'dr_cr_imbalance'", *_NO_LINE, "geo || '/' || ledger_source",
           f"'accounted_dr=' || {_text('accounted_dr')} || ' accounted_cr=' || {_text('accounted_cr')} || ' diff=' || {_text('diff')}", "tb_unbal"),
    _issue("batch_id", "'n_unknown_accounts'", "'unknown_account'", "journal_id", "journal_line_num", "geo", "account", "tb_unknown"),
    _issue("batch_id", "'n_missing_geos'", "'missing_geo'", *_NO_LINE, "'geo'", "geo", "tb_missing"),
    _issue("batch_id", "'n_net_movement'", "'net_movement'", *_NO_LINE, "geo || '/' || account",
           f"""'net_movement=' || {_text('net_movement')} || ' limit=' || {_text('"limit"')}""", "tb_net")])

APPROVAL_ISSUES = " UNION ALL ".join([
    _issue("batch_id", "'approval'", "'not_primary'", "journal_id", "journal_line_num", "'ledger_id'", "ledger_id",
           "entries WHERE NOT ends_with(coalesce(ledger_id, ''), '-PRIMARY')"),
    *[_issue("batch_id", "'approval'", "'negative_amount'", "journal_id", "journal_line_num", f"'{c}'", _text(c), f"entries WHERE {c} < 0")
      for c in ("entered_dr", "entered_cr", "accounted_dr", "accounted_cr")],
    _issue("batch_id", "'approval'", "'duplicate_key'", *_NO_LINE, "'surrogate_key'", "surrogate_key || ' x' || CAST(n - 1 AS VARCHAR)",
           "(SELECT batch_id, surrogate_key, count(*) AS n FROM entries GROUP BY 1, 2 HAVING count(*) > 1)")])

_CUT = """
cut AS (SELECT * REPLACE (CAST(NULL AS DECIMAL(20,4)) AS accounted_cr, CAST(NULL AS VARCHAR) AS segment3_account) FROM dedup)"""
_MISSING = " UNION ALL ".join([
    "SELECT batch_id, 'missing_columns' AS issue_type, 'accounted_cr,segment3_account' AS c FROM (SELECT DISTINCT batch_id FROM cut)",
    "SELECT batch_id, 'null_violation', c FROM (SELECT batch_id, "
    + _blank_list([c for c in NON_NULLABLE_COLUMNS if c not in ("segment3_account", "accounted_cr")]) + " AS c FROM cut) WHERE c <> ''",
    "SELECT batch_id, 'dr_cr_imbalance', NULL FROM (" + _unbalanced.format(src="cut") + ")",
    *[f"SELECT batch_id, 'segment_violation', '{c}' FROM cut WHERE {c} IS NULL OR trim({c}) = ''" for c in SEGMENT_COLUMNS]])

_SILVER_REASON = "concat_ws(',', " + ", ".join(
    f"CASE WHEN {c} IS NULL THEN '{c}' END" for c in NON_NULLABLE_COLUMNS if c != "load_timestamp") + ")"

ORACLES.update({
    "stream_silver": with_ctes(STREAM_ROWS, body=f"""
SELECT CASE WHEN r = '' THEN 'silver' ELSE 'quarantine' END AS sink, r AS quarantine_reason, count(*) AS n
FROM (SELECT {_SILVER_REASON} AS r FROM (SELECT DISTINCT ON (surrogate_key) * FROM ev)) GROUP BY 1, 2"""),
    "tb_issues": with_ctes(*SILVER, TB_CHECKS, body=TB_ISSUES),
    "approval_issues": with_ctes(*SILVER, entries_cte("MONTHLY"), body=APPROVAL_ISSUES),
    "mec_missing_columns": with_ctes(*SILVER, _CUT, body=f"""
SELECT batch_id, issue_type, c AS "column", count(*) AS n_issues FROM ({_MISSING}) GROUP BY 1, 2, 3"""),
    "ingest_mixed_shapes": with_ctes(RAW, _SHAPES, body=f"SELECT {_COLUMNS} FROM canon"),
    "batch_silver": with_ctes(RAW, _AR_CANON, VALID, _BATCH_DEDUP, body=f"SELECT {_COLUMNS} FROM bsilver"),
    "amount_edges": with_ctes(RAW, _EDGES, body="""
SELECT batch_id, CAST(sum(coalesce(wide, 0)) AS DECIMAL(38,6)) AS accounted_dr, count(*) AS n_lines,
  count(*) FILTER (a IS NOT NULL AND a <> '' AND (kept IS NULL OR wide IS NULL OR wide <> kept)) AS n_lost
FROM typed GROUP BY 1"""),
    "rerun_corrected_batch": with_ctes(RAW, _AR_CANON, VALID, _BATCH_DEDUP, body="""
SELECT batch_id, 'silver' AS sink, count(*) AS n FROM bsilver WHERE batch_id <> (SELECT min(batch_id) FROM raw) GROUP BY 1
UNION ALL SELECT batch_id, 'quarantine', count(*) FROM classified
WHERE quarantine_reason <> '' OR batch_id = (SELECT min(batch_id) FROM raw) GROUP BY 1"""),
    "gold_one_batch": with_ctes(*SILVER, body=f"SELECT {_COLUMNS} FROM dedup WHERE batch_id = 'b1995'"),
    "roundtrip_trial_balance": with_ctes(RAW, TB_TABLE, body="""
SELECT geo, account, CAST(opening AS DECIMAL(38,4)) AS opening, CAST(activity AS DECIMAL(38,4)) AS activity FROM tb"""),
    "entries_window": with_ctes(*SILVER, entries_cte("QUARTERLY"), body="""
SELECT batch_id, ledger_source, geo, is_fallback, count(*) AS n_lines, CAST(sum(accounted_dr) AS DECIMAL(38,4)) AS accounted_dr
FROM entries WHERE batch_id = 'je-quarterly-1995-03-31' GROUP BY 1, 2, 3, 4"""),
    "duplicate_lines": with_ctes(*SILVER, body="""
SELECT batch_id, delivery, count(*) AS n_rows FROM ranked WHERE rn > 1 GROUP BY 1, 2"""),
})

#: The second run commits first; the first one decides anew and finds every batch posted.
ORACLES["booking_race"] = f"""
SELECT batch_id, run, CASE WHEN run = 'first' AND status = 'POSTED' THEN 'ALREADY_BOOKED' ELSE status END AS status,
       CAST(CASE WHEN status = 'POSTED' THEN 1 ELSE 0 END AS BIGINT) AS n_posted
FROM ({ORACLES['booking_status']}), (VALUES ('first'), ('second')) r(run)"""

ORACLES.update({
    "roundtrip_reference": """
SELECT DISTINCT 'segment3_account' AS segment, p_type AS value FROM part WHERE p_type <> 'MEDIUM'""",
    "booked_sinks": f"""
SELECT 'entries' AS sink, 'QUARTERLY' AS period_type, batch_id, count(*) AS n_rows, CAST(sum(accounted_dr) AS DECIMAL(38,4)) AS accounted_dr
FROM ({with_ctes(*SILVER, entries_cte("QUARTERLY"), body="SELECT batch_id, accounted_dr FROM entries")}) GROUP BY batch_id
UNION ALL SELECT 'booked', 'QUARTERLY', batch_id, count(*), CAST(sum(accounted_dr) AS DECIMAL(38,4)) FROM ({ORACLES['book_quarterly']}) GROUP BY batch_id""",
    "entry_upserts": with_ctes(*MONTHLY, body="""
SELECT batch_id, count(*) AS n_rows, CAST(sum(v + CASE WHEN substr(surrogate_key, 1, 1) < '8' THEN 1 ELSE 0 END) AS DECIMAL(38,4)) AS accounted_dr
FROM (SELECT batch_id, surrogate_key, geo, min(accounted_dr) AS v FROM entries GROUP BY 1, 2, 3) GROUP BY batch_id"""),
    "issue_reports": f"""
SELECT 'mec' AS gate, batch_id, 'landing/in' AS source_bucket, batch_id || '.json' AS source_key, checks_run, checks_passed, checks_failed,
       n_completeness_issues, n_balance_issues, n_segment_issues
FROM ({ORACLES['mec_summary']}) WHERE NOT is_valid""",
    "landed_files": with_ctes(RAW, _AR_CANON, VALID, _BATCH_DEDUP, body="""
SELECT batch_id, 'gold' AS sink, count(*) AS n FROM bsilver GROUP BY 1
UNION ALL SELECT batch_id, 'quarantine', count(*) FROM classified WHERE quarantine_reason <> '' GROUP BY 1"""),
})

_FILE_ORDER = ", ".join(f"{c} NULLS FIRST" for c in (
    "journal_id", "line_num", "ledger_id", "acct_date", "currency_code", "entered_dr", "entered_cr", "accounted_dr", "accounted_cr", "fx_rate",
    *SEGMENT_COLUMNS[:-1], "description"))
_NUMBERED = f"""
numbered AS (SELECT *, row_number() OVER (PARTITION BY batch_id ORDER BY {_FILE_ORDER}) AS row_ordinal FROM raw)"""
_LINE = "batch_id, row_ordinal, journal_id, journal_line_num"
ORACLES["issue_ordinals"] = with_ctes(
    RAW, _NUMBERED, _AR_CANON.replace("geo_tag, delivery\n  FROM raw", "geo_tag, delivery, row_ordinal\n  FROM numbered"), ACCOUNT_REF, f"""
segs AS (UNPIVOT (SELECT {_LINE}, {", ".join(f"coalesce({c}, '') AS {c}" for c in SEGMENT_COLUMNS)} FROM canon)
  ON {", ".join(SEGMENT_COLUMNS)} INTO NAME segment VALUE value)""", body=f"""
SELECT {_LINE}, 'null_violation' AS issue_type, {_blank_list(NON_NULLABLE_COLUMNS)} AS "column", CAST(NULL AS VARCHAR) AS detail
FROM canon WHERE {_blank_list(NON_NULLABLE_COLUMNS)} <> ''
UNION ALL
SELECT {_LINE}, 'segment_violation', segment, CASE WHEN trim(value) = '' THEN '<empty>' ELSE value END
FROM segs WHERE trim(value) = '' OR segment IN (SELECT segment FROM ref) AND NOT EXISTS (SELECT 1 FROM ref r WHERE r.segment = segs.segment AND r.value = segs.value)""")

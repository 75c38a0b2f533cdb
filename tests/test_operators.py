import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from fxlake.operators import approval as AP
from fxlake.operators import booking as BK
from fxlake.operators import trial_balance as TB
from fxlake.operators import validate as V
from fxlake.operators.canonical import canonicalize, complete_schema
from fxlake.operators.dedup import keep_one_per_key, later_occurrences, new_against_registry
from fxlake.operators.entries import fan_out, generate, period_end
from fxlake.operators.numbering import number_within
from fxlake.operators.period import aggregate_for_period
from fxlake.operators.quality import quarantine_split
from fxlake.schema import CANONICAL_COLUMNS

RAW_COLS = ("journal_id string, line_num string, ledger_id string, acct_date string, currency_code string, "
            "entered_dr string, entered_cr string, accounted_dr string, accounted_cr string, fx_rate string, "
            "segment1_entity string, segment2_cost_center string, segment3_account string, "
            "segment4_project string, segment5_intercompany string, segment6_product string")


def raw_rows(spark, rows):
    return spark.createDataFrame(rows, RAW_COLS)


def line(j, n, dr=None, cr=None, acct="1000", date="2024-01-15", rate="1", ledger="US-PRIMARY"):
    return (j, str(n), ledger, date, "USD", dr, cr, dr, cr, rate, "E1", "CC", acct, "P", "IC", "PR")


def test_canonicalize_aliases_defaults_and_try_cast(spark):
    df = raw_rows(spark, [line("J1", 1, dr="10.5"), line("J1", "x", cr="oops", date="bad")])
    out = canonicalize(df, batch_id="b1").orderBy("journal_line_num").collect()
    assert out[0].journal_line_num is None and out[0].effective_date is None
    assert out[0].entered_cr is None  # unparseable amount -> null, not an error
    assert out[1].journal_line_num == 1 and str(out[1].entered_dr) == "10.5000"
    assert out[1].segment7_spare == "000" and out[1].description == ""
    assert out[1].period_name == "JAN-2024" and out[1].batch_id == "b1"
    assert [c for c in canonicalize(df, batch_id="b1").columns] == CANONICAL_COLUMNS


def test_canonicalize_requires_identifiers(spark):
    df = spark.createDataFrame([("J1",)], "journal_id string")
    with pytest.raises(ValueError):
        canonicalize(df, batch_id="b1")


def test_quarantine_split_is_an_exact_complement(spark):
    df = canonicalize(raw_rows(spark, [line("J1", 1, dr="1"), line("J2", 1, dr="1", rate=None),
                                       line("J3", 1, dr="1", date=None)]), batch_id="b")
    valid, bad = quarantine_split(df)
    assert valid.count() + bad.count() == df.count() == 3
    reasons = {r.journal_id: r.quarantine_reason for r in bad.collect()}
    assert reasons == {"J2": "fx_rate", "J3": "effective_date,period_name"}


def test_keep_one_per_key_is_deterministic_and_unique(spark):
    df = spark.createDataFrame([("k1", "h2", 1), ("k1", "h1", 2), ("k1", "h1", 1), ("k2", "h9", 1)],
                               "surrogate_key string, payload_hash string, delivery int")
    out = sorted(tuple(r) for r in keep_one_per_key(df, "surrogate_key", ["payload_hash", "delivery"]).collect())
    assert out == [("k1", "h1", 1), ("k2", "h9", 1)]


def test_later_occurrences_keeps_multiplicity(spark):
    df = spark.createDataFrame([("k1", "a"), ("k1", "a"), ("k1", "b"), (None, "x"), (None, "y"), ("k2", "z")],
                               "surrogate_key string, v string")
    assert later_occurrences(df).count() == 3


def test_new_against_registry(spark):
    lines = spark.createDataFrame([("k1", "h"), ("k2", "h"), ("k2", "h")], "surrogate_key string, payload_hash string")
    reg = spark.createDataFrame([("k1", "bronze"), ("k2", "silver")], "surrogate_key string, stage string")
    assert [r.surrogate_key for r in new_against_registry(lines, reg, "bronze").collect()] == ["k2"]


def test_unbalanced_journals_and_unknown_journal(spark):
    df = spark.createDataFrame(
        [("b", "J1", "10", None), ("b", "J1", None, "10"), ("b", "J2", "5", "4.99"), ("b", None, "1", None),
         ("b", "J3", "null", ""), ("b", "J3", "abc", None)],
        "batch_id string, journal_id string, accounted_dr string, accounted_cr string")
    got = {r.journal_id: (str(r.accounted_dr), str(r.accounted_cr)) for r in V.unbalanced_journals(df).collect()}
    assert got == {"J2": ("5.0000", "4.9900"), "UNKNOWN": ("1.0000", "0.0000")}


def test_segment_violations_blank_and_membership(spark):
    df = canonicalize(raw_rows(spark, [line("J1", 1, dr="1", acct="1000"), line("J1", 2, cr="1", acct="9999"),
                                       line("J1", 3, cr="1", acct=" ")]), batch_id="b")
    ref = V.reference_values(spark, {"segment3_account": ["1000"]})
    got = sorted((r.segment, r.value) for r in V.segment_violations(df, ref).collect())
    assert got == [("segment3_account", "9999"), ("segment3_account", "<empty>")]
    # Without a list for a segment, only blanks count.
    assert V.segment_violations(df, None).count() == 1


def test_validation_summary_and_empty_batch(spark):
    raw = raw_rows(spark, [line("J1", 1, dr="1"), line("J1", 2, cr="1")])
    # A missing description defaults to '' and is then rejected as blank (kept on purpose).
    blank = V.summary(canonicalize(raw, batch_id="b1"), V.issues(canonicalize(raw, batch_id="b1"))).first()
    assert not blank.is_valid and blank.n_completeness_issues == 2
    df = canonicalize(raw.withColumn("description", F.lit("adj")), batch_id="b1")
    iss = V.issues(df)
    batches = spark.createDataFrame([("b1",), ("b2",)], "batch_id string")
    rows = {r.batch_id: r for r in V.summary(df, iss, batches).collect()}
    assert rows["b1"].is_valid and rows["b1"].checks_passed == 3
    assert not rows["b2"].is_valid and rows["b2"].empty_reason == "no_journal_lines"


def test_trial_balance_checks(spark):
    lines = spark.createDataFrame(
        [("b", "US", "AP", "1000", "J1", 1, "10", None), ("b", "US", "AP", "2000", "J1", 2, None, "9"),
         ("b", "XX", "AR", "7777", "J2", 1, "1", "1")],
        "batch_id string, geo string, ledger_source string, segment3_account string, journal_id string, "
        "journal_line_num int, accounted_dr string, accounted_cr string")
    tb = spark.createDataFrame([("US", "1000", 1, 1)], "geo string, account string, opening int, activity int") \
        .select("geo", "account", F.col("opening").cast("decimal(20,4)").alias("opening"),
                F.col("activity").cast("decimal(20,4)").alias("activity"))
    assert [(r.geo, r.ledger_source, str(r.diff)) for r in TB.unbalanced_geo_source(lines).collect()] == \
        [("US", "AP", "1.0000")]
    # XX has no trial balance: skipped. 2000 is unknown in US.
    assert [(r.geo, r.account) for r in TB.unknown_accounts(lines, tb).collect()] == [("US", "2000")]
    assert sorted(r.geo for r in TB.missing_geos(lines, ["US", "EU"]).collect()) == ["EU"]
    assert [(r.account, str(r.net_movement)) for r in TB.net_movement_exceeded(lines, tb).collect()] == \
        [("1000", "10.0000")]
    s = TB.summary(lines, tb, ["US", "EU"]).first()
    assert s.issue_count == 1 + 1 + 1 + 1 and not s.is_valid


def test_number_within_matches_row_number(spark):
    df = spark.range(0, 2000).select(
        (F.col("id") % 3).cast("string").alias("g"), F.col("id").alias("o"),
        F.rand(7).alias("r")).withColumn("g", F.when(F.col("o") < 1500, F.lit("hot")).otherwise(F.col("g")))
    got = number_within(df, ["g"], ["r", "o"], out="n", partitions=7)
    ref = df.withColumn("n", F.row_number().over(Window.partitionBy("g").orderBy("r", "o")))
    assert got.select("g", "o", "n").exceptAll(ref.select("g", "o", "n")).count() == 0
    assert got.count() == 2000


def _sub_lines(spark):
    cols = ("journal_id string, journal_line_num int, surrogate_key string, ledger_source string, geo_tag string, "
            "effective_date date, entered_dr decimal(20,4), entered_cr decimal(20,4), segment3_account string")
    rows = [("J1", 1, "a", "AP", "US", "2024-01-10", 10, None, "1000"),
            ("J1", 2, "b", "AP", None, "2024-01-11", None, 10, "1000"),
            ("J2", 1, "c", "AR", "EMEA", "2024-02-01", 5, None, "2000"),
            ("J2", 2, "d", "AR", "EMEA", "2024-02-01", None, 5, "2000")]
    conv = [(*r[:5], dt.date.fromisoformat(r[5]),
             None if r[6] is None else Decimal(r[6]), None if r[7] is None else Decimal(r[7]), r[8]) for r in rows]
    return spark.createDataFrame(conv, cols)


def test_fan_out_matches_untagged_and_fallback(spark):
    lines = _sub_lines(spark).withColumn("batch_id", F.lit("B"))
    out = fan_out(lines, ["US", "EMEA"], ["AP", "AR"])
    got = sorted((r.ledger_source, r.geo, r.journal_line_num, r.is_fallback) for r in out.collect())
    # AP: line 1 only US, line 2 untagged -> both geos. AR: no US line -> fallback takes all AR lines.
    assert got == [("AP", "EMEA", 2, False), ("AP", "US", 1, False), ("AP", "US", 2, False),
                   ("AR", "EMEA", 1, False), ("AR", "EMEA", 2, False), ("AR", "US", 1, True), ("AR", "US", 2, True)]


def test_generate_entries_defaults_and_numbering(spark):
    e = generate(_sub_lines(spark), "MONTHLY", geos=["US", "EMEA"], sources=["AP", "AR"])
    rows = e.collect()
    assert {r.batch_id for r in rows} == {"je-monthly-2024-01-31", "je-monthly-2024-02-29"}
    us_ap = sorted(r.journal_line_num for r in rows if r.geo == "US" and r.ledger_source == "AP")
    assert us_ap == [1, 2]
    r = rows[0]
    assert r.currency_code == "USD" and r.segment2_cost_center == "DEFAULT" and r.ledger_id.endswith("-PRIMARY")
    assert str(r.fx_rate) == "1.00000000" and r.segment6_product == "GENERAL"


def test_period_end_blocks(spark):
    df = spark.createDataFrame([("2024-05-17",)], "d string").select(F.col("d").cast("date").alias("d"))
    got = df.select(*[period_end("d", m).cast("string").alias(f"m{m}") for m in (1, 3, 12)]).first()
    assert (got.m1, got.m3, got.m12) == ("2024-05-31", "2024-06-30", "2024-12-31")


def test_period_aggregation_preserves_totals(spark):
    e = generate(_sub_lines(spark), "YEARLY", geos=["US", "EMEA"], sources=["AP", "AR"]).drop("is_fallback")
    q = aggregate_for_period(e, "YEARLY")
    tot = lambda df: df.agg(F.sum("entered_dr"), F.sum("entered_cr")).first()
    assert [float(x) for x in tot(e)] == [float(x) for x in tot(q)]
    assert q.filter(F.col("description").startswith("YEARLY FX adjustment")).count() == q.count()
    assert aggregate_for_period(e, "MONTHLY").count() == e.count()


def test_approval_first_decision_wins_and_rejections(spark):
    reqs = spark.createDataFrame([("a1", "B1"), ("a2", "B2")], "approval_id string, batch_id string")
    dec = spark.createDataFrame(
        [(1, "a1", "reject", "u1", "2024-01-02"), (2, "a1", "APPROVE", "u2", "2024-01-01"),
         (3, "a2", "maybe", "u3", "2024-01-01"), (4, "zz", "approve", None, "2024-01-01")],
        "decision_id long, approval_id string, action string, approver string, decided_at string")
    acc, rej = AP.valid_decisions(dec, reqs)
    state = {r.approval_id: (r.status, r.approved_by) for r in AP.current_state(reqs, acc).collect()}
    assert state == {"a1": ("APPROVED", "u2"), "a2": ("PENDING", "")}
    assert sorted((r.decision_id, r.reason) for r in rej.collect()) == [(3, "invalid_action"), (4, "unknown_approval")]


def test_booking_status_order(spark):
    batches = spark.createDataFrame([("B1",), ("B2",), ("B3",), ("B4",)], "batch_id string")
    val = spark.createDataFrame([("B1", False), ("B2", True), ("B3", True), ("B4", True)], "batch_id string, is_valid boolean")
    appr = spark.createDataFrame([("B2", "REJECTED"), ("B3", "APPROVED"), ("B4", "APPROVED")], "batch_id string, status string")
    audit = spark.createDataFrame([("r", "B3", "POSTED"), ("r2", "B4", "FAILED")],
                                  "booking_run_id string, journal_batch_id string, status string")
    counts = spark.createDataFrame([("B4", 7)], "batch_id string, line_count long")
    got = {r.batch_id: r for r in BK.booking_status(batches, val, appr, audit, counts, "MONTHLY").collect()}
    assert [got[b].status for b in ["B1", "B2", "B3", "B4"]] == \
        ["BLOCKED_VALIDATION", "NOT_APPROVED", "ALREADY_BOOKED", "POSTED"]
    assert got["B4"].line_count == 7 and got["B4"].ofa_journal_ref.startswith("OFA-MON-B4-")


def test_complete_schema_types_missing_columns(spark):
    df = spark.createDataFrame([("J1",)], "journal_id string")
    out = complete_schema(df)
    assert out.columns == CANONICAL_COLUMNS
    assert dict(out.dtypes)["entered_dr"] == "decimal(20,4)" and dict(out.dtypes)["effective_date"] == "date"


def test_gate_summary_equals_the_summary_of_issues(spark):
    from pyspark.sql import functions as F

    from fxlake.operators import validate as V
    from fxlake.schema import CANONICAL_SCHEMA

    rows = spark.range(60).select(*[
        {"journal_id": F.concat(F.lit("J"), F.col("id") % 7), "batch_id": F.concat(F.lit("b"), F.col("id") % 3),
         "accounted_dr": F.when(F.col("id") % 5 != 0, F.lit(1)), "accounted_cr": F.when(F.col("id") % 4 != 0, F.lit(1)),
         "segment3_account": F.when(F.col("id") % 11 == 0, F.lit(" ")).otherwise(F.concat(F.lit("A"), F.col("id") % 4)),
         "ledger_id": F.when(F.col("id") % 13 == 0, F.lit(None)).otherwise(F.lit("L"))}.get(f.name, F.lit("1")).try_cast(f.dataType).alias(f.name)
        for f in CANONICAL_SCHEMA.fields])
    ref = V.reference_values(spark, {"segment3_account": ["A0", "A1"], "segment1_entity": ["1"]})
    for lines in (rows, rows.drop("accounted_cr", "segment3_account"), rows.limit(0)):
        for reference in (ref, None):
            want = sorted(map(tuple, V.summary(lines, V.issues(lines, reference)).collect()))
            assert sorted(map(tuple, V.gate_summary(lines, reference).collect())) == want

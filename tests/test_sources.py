import json
import os

from fxlake.operators.canonical import canonicalize
from fxlake.operators.trial_balance import read_trial_balance
from fxlake.sources import files as FS


def test_csv_keeps_leading_zeros(spark, tmp_dir):
    p = os.path.join(tmp_dir, "batch_001.csv")
    with open(p, "w") as f:
        f.write("journal_id,line_num,ledger_id,acct_date,currency_code,entered_dr,fx_rate,segment1_entity\n")
        f.write("J1,1,US-PRIMARY,2024-01-31,USD,10,1,001\n")
    df = FS.read_batch(spark, p)
    row = canonicalize(FS.with_file_batch_id(df), batch_id=None).first()
    assert row.segment1_entity == "001" and row.batch_id == "batch_001" and row.journal_line_num == 1


def test_json_shapes_bare_wrapped_records_and_other(spark, tmp_dir):
    line = {"journal_id": "J1", "ledger_id": "L", "currency_code": "USD", "entered_dr": "1.5"}
    shapes = {"bare.json": [line, line], "wrapped.json": {"journal_lines": [line]},
              "records.json": {"records": [line, line, line]}, "other.json": {"foo": 1}}
    counts = {}
    for name, doc in shapes.items():
        p = os.path.join(tmp_dir, name)
        with open(p, "w") as f:
            json.dump(doc, f, indent=2)
        counts[name] = FS.read_batch(spark, p).count()
    assert counts == {"bare.json": 2, "wrapped.json": 1, "records.json": 3, "other.json": 0}


def test_silver_sink_dynamic_overwrite_is_idempotent(spark, tmp_dir):
    out = os.path.join(tmp_dir, "silver")
    a = spark.createDataFrame([("k1", "b1"), ("k2", "b2")], "surrogate_key string, batch_id string")
    FS.write_silver(a, out)
    FS.write_silver(spark.createDataFrame([("k3", "b1")], "surrogate_key string, batch_id string"), out)
    FS.write_silver(spark.createDataFrame([("k3", "b1")], "surrogate_key string, batch_id string"), out)
    got = sorted(tuple(r) for r in spark.read.parquet(out).collect())
    assert got == [("k2", "b2"), ("k3", "b1")]


def test_quarantine_sink_keeps_null_fields(spark, tmp_dir):
    out = os.path.join(tmp_dir, "q")
    FS.write_quarantine(spark.createDataFrame([("J1", None, "b1")], "journal_id string, fx_rate string, batch_id string"), out)
    text = open([os.path.join(dp, f) for dp, _, fs in os.walk(out) for f in fs if f.endswith(".json")][0]).read()
    assert '"fx_rate":null' in text


def test_trial_balance_and_reference_json(spark, tmp_dir):
    tb = os.path.join(tmp_dir, "tb.json")
    with open(tb, "w") as f:
        json.dump({"US": {"1001": {"opening": "100", "activity": "50"}, "1002": {"opening": "x"}}}, f, indent=1)
    rows = sorted((r.geo, r.account, str(r.opening), str(r.activity)) for r in read_trial_balance(spark, tb).collect())
    assert rows == [("US", "1001", "100.0000", "50.0000"), ("US", "1002", "0.0000", "0.0000")]
    assert read_trial_balance(spark, None).count() == 0
    ref = os.path.join(tmp_dir, "ref.json")
    with open(ref, "w") as f:
        json.dump({"accounts": ["1000", "2000"], "entities": []}, f)
    got = sorted((r.segment, r.value) for r in FS.read_reference_values(spark, ref).collect())
    assert got == [("segment3_account", "1000"), ("segment3_account", "2000")]


def test_entry_upsert_replaces_by_key(spark, tmp_dir):
    path = os.path.join(tmp_dir, "entries")
    schema = "surrogate_key string, batch_id string, geo string, v int"
    FS.upsert_entries(spark, path, spark.createDataFrame([("k1", "B", "US", 1), ("k2", "B", "US", 1)], schema))
    FS.upsert_entries(spark, path, spark.createDataFrame([("k1", "B", "US", 2), ("k1", "B", "UK", 3)], schema))
    got = sorted(tuple(r) for r in spark.read.parquet(path).select("surrogate_key", "geo", "v", "batch_id").collect())
    assert got == [("k1", "UK", 3, "B"), ("k1", "US", 2, "B"), ("k2", "US", 1, "B")]


def test_gold_batch_prunes_partitions(spark, tmp_dir):
    from fxlake.operators.canonical import gold_batch

    out = os.path.join(tmp_dir, "silver")
    FS.write_silver(spark.createDataFrame([("k1", "b1"), ("k2", "b2")], "surrogate_key string, batch_id string"), out)
    gold = gold_batch(FS.read_silver(spark, out), "b2")
    plan = gold._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [(batch_id" in plan and "= b2)" in plan
    rows = gold.collect()
    assert [r.surrogate_key for r in rows] == ["k2"] and rows[0].gold_timestamp is not None
    assert gold.columns[:24] == FS.CANONICAL_SCHEMA.fieldNames()


def test_mixed_shapes_in_one_pass(spark, tmp_dir):
    """Lines, documents, broken text and empty files in one folder: whole files and, with a small limit, the large-file path agree."""
    line = {"journal_id": "J1", "entered_dr": "1.50", "ledger_id": "L"}
    files = {"bare.json": json.dumps([line, line], indent=1), "lines.json": "\n".join([json.dumps(line), "oops", "", json.dumps({"records": [line]})]),
             "crlf.json": json.dumps(line) + "\r\n" + json.dumps(line) + "\r\n", "mostly.json": "# a comment\n" + "\n".join([json.dumps(line)] * 3),
             "wrapped.json": json.dumps({"journal_lines": [line]}, indent=2), "empty.json": "", "blank.json": "\n \n", "other.json": '{"foo": 1}',
             "bad.json": '{"journal_id": "J1",\n "entered_dr":', "numbers.json": "[1, 2]"}
    for name, text in files.items():
        with open(os.path.join(tmp_dir, name), "w", newline="") as f:
            f.write(text)

    def found(**options):
        rows = FS.with_file_batch_id(FS.read_json_batch(spark, tmp_dir, **options)).collect()
        return sorted((r.batch_id, r.journal_id or "", r.entered_dr or "") for r in rows)

    good = ("J1", "1.50")
    want = sorted([("bare", *good)] * 2 + [("lines", *good)] * 2 + [("lines", "", "")] + [("crlf", *good)] * 2 + [("mostly", "", "")] + [("mostly", *good)] * 3
                  + [("wrapped", *good), ("bad", "", ""), ("numbers", "", "")])
    assert found() == want
    assert [r for r in found(whole_bytes=20) if r[0] in ("bare", "lines", "crlf", "wrapped")] == [r for r in want if r[0] in ("bare", "lines", "crlf", "wrapped")]


def test_json_files_are_read_once(spark, tmp_dir):
    for k in range(3):
        with open(os.path.join(tmp_dir, f"{k}.json"), "w") as f:
            f.write("\n".join(json.dumps({"journal_id": f"J{n}"}) for n in range(50)))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("one-pass", "read")
    df = FS.read_json_batch(spark, tmp_dir)
    listed = len(tracker.getJobIdsForGroup("one-pass"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan text") == 1 and "FileScan json" not in plan
    assert df.count() == 150 and listed <= 1
    spark.sparkContext.setJobGroup("", "")


def test_ordinals_over_splits_files_and_shapes(spark, tmp_dir):
    """Files of many splits, one with blank lines, and JSON of both shapes: each row's place in its own file."""
    header = "journal_id,line_num,ledger_id,currency_code"
    for name, n in (("a", 400), ("b", 3), ("empty", 0)):
        with open(os.path.join(tmp_dir, f"{name}.csv"), "w") as f:
            f.write("\n".join([header, *[f"{name}-{i + 1},{i % 2},L,{'X' * (i % 37)}" for i in range(n)]]) + "\n\n")
    with open(os.path.join(tmp_dir, "c.json"), "w") as f:
        json.dump({"journal_lines": [{"journal_id": f"c-{i + 1}"} for i in range(5)]}, f)
    with open(os.path.join(tmp_dir, "d.json"), "w") as f:
        f.writelines(json.dumps({"records": [{"journal_id": f"d-{2 * i + 1}"}, {"journal_id": f"d-{2 * i + 2}"}]}) + "\n" for i in range(9))
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    kept = [spark.conf.get(k) for k in names]
    try:
        for k, v in zip(names, ("700", "1")):
            spark.conf.set(k, v)
        read = FS.read_batch(spark, tmp_dir, positions=True)
        assert read.select("_source_path", "_source_block").distinct().count() > 10
        rows = FS.with_ordinals(read).select("journal_id", "row_ordinal").collect()
    finally:
        for k, v in zip(names, kept):
            spark.conf.set(k, v)
    assert len(rows) == 400 + 3 + 5 + 18
    assert all(r.row_ordinal == int(r.journal_id.split("-")[1]) for r in rows)

"""What the plans leave out of shuffles and files, on rows of their own."""

import glob
import os

from pyspark.sql import Window
from pyspark.sql import functions as F

from fxlake.operators import approval as AP
from fxlake.operators import dedup as D
from fxlake.operators import entries as E
from fxlake.operators import numbering as N
from fxlake.operators import period as P
from fxlake.operators import validate as V
from fxlake.plans import catalog, journal
from fxlake.schema import SEGMENT_COLUMNS
from fxlake.sources import files as FS
from tests.conftest import SMOKE_DIR


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_every_repeated_key_is_marked_and_few_others(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 5 == 0, F.lit(None)).otherwise((F.col("id") % 2000).cast("string")).alias("k"), "id")
    counts = df.groupBy("k").count()
    out = D.with_repeats(df, ["k"]).join(counts, df.k.eqNullSafe(counts.k))
    assert out.where("count > 1 AND NOT _again").count() == 0
    assert out.where("count = 1 AND _again").count() < 60
    assert D.with_repeats(spark.range(10).select("id"), ["id"]).where("_again").count() == 0


def test_rows_of_unique_keys_are_not_shuffled(spark):
    df = spark.range(100).select(F.col("id").cast("string").alias("surrogate_key"), F.lit("h").alias("payload_hash"))
    one = D.keep_one_per_key(df)
    assert "Exchange" not in _plan(one) and one.count() == 100
    assert D.later_occurrences(df).count() == 0 and D.duplicate_key_counts(df).count() == 0


def test_keep_one_per_key_with_null_and_repeated_keys(spark):
    rows = [(None, "b", 1), (None, "a", 2), ("x", "c", 1), ("x", "c", 0), ("y", "z", 9)]
    df = spark.createDataFrame(rows, "surrogate_key string, payload_hash string, delivery int")
    got = sorted(map(tuple, D.keep_one_per_key(df, "surrogate_key", ["payload_hash", "delivery"]).collect()), key=str)
    assert got == [("x", "c", 0), ("y", "z", 9), (None, "a", 2)]
    assert sorted(map(tuple, D.duplicate_key_counts(df).collect())) == [("", 2), ("x", 2)]
    assert D.later_occurrences(df, order_by=["payload_hash", "delivery"]).count() == 2


def test_numbering_takes_partitions_by_rows_and_keeps_what_is_asked(spark, monkeypatch):
    monkeypatch.setattr(N, "ROWS_A_PARTITION", 10)
    staged = []
    stage = N.stage_table
    monkeypatch.setattr(N, "stage_table", lambda df, label: staged.append(df) or stage(df, label))
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), (F.lit(1000) - F.col("id")).alias("o"), F.col("id").alias("v"))
    out = N.number_within(df, ["g"], ["o"], out="n", keep=["v"])
    assert "o" not in staged[0].columns and staged[0].rdd.getNumPartitions() > 50
    assert sorted(map(tuple, out.select("g", "v", "n").collect())) == sorted(
        (i % 3, i, sum(1 for j in range(i, 1000) if j % 3 == i % 3)) for i in range(1000))


def test_lines_are_not_shuffled_for_the_reference_lists(spark):
    lines = spark.range(50).select(F.lit("b").alias("batch_id"), F.col("id").cast("string").alias("journal_id"), F.lit(1).alias("journal_line_num"),
                                   *[F.col("id").cast("string").alias(c) for c in SEGMENT_COLUMNS])
    # Few values from an input that looks large to the planner.
    reference = spark.range(1 << 22).select(F.lit("segment1_entity").alias("segment"), (F.col("id") % 40).cast("string").alias("value"))
    found = V.segment_violations(lines, reference)
    assert "SortMergeJoin" not in _plan(found) and found.count() == 10


def test_tables_of_keyed_lines_hold_no_digests_but_give_them(spark):
    silver = journal.silver_lines(spark, SMOKE_DIR)
    path = silver.inputFiles()[0]
    assert not {"surrogate_key", "payload_hash"} & set(spark.read.parquet(path).columns)
    built = journal.silver_lines(spark, SMOKE_DIR, staged=False)
    assert silver.columns == built.columns
    assert silver.exceptAll(built).count() == 0 and built.exceptAll(silver).count() == 0


def test_repeated_entry_keys_of_a_batch(spark):
    rows = [("b1", "k"), ("b1", "k"), ("b1", None), ("b1", ""), ("b2", "k"), (None, "k"), (None, "k")]
    df = spark.createDataFrame(rows, "batch_id string, surrogate_key string")
    got = {r.batch_id: r.n_duplicate_keys for r in AP.request_issues(df).collect()}
    assert got == {"b1": 2, "b2": 0, None: 1}


def test_landing_files_are_compressed(spark, monkeypatch, tmp_dir):
    monkeypatch.setattr(catalog, "_scratch", lambda spark, label: tmp_dir)
    catalog.roundtrip_json_wrapped(spark, SMOKE_DIR)
    files = glob.glob(f"{tmp_dir}/landing/*/part-*")
    assert files and all(os.path.basename(f).endswith(".gz") for f in files)


def test_sinks_shuffle_no_digests_that_the_columns_give_and_keep_others(spark, tmp_dir):
    lines = journal.silver_lines(spark, SMOKE_DIR).limit(60)
    foreign = F.pmod(F.xxhash64("journal_id"), F.lit(3))
    mixed = lines.withColumns({"surrogate_key": F.when(foreign == 0, F.lit("own")).when(foreign == 1, F.lit(None)).otherwise(F.col("surrogate_key")),
                               "payload_hash": F.when(foreign == 0, F.lit(None)).otherwise(F.col("payload_hash"))})
    for k, df in enumerate((lines, mixed)):
        df = df.localCheckpoint()
        slim = FS._without_digests(df)
        assert slim.where("surrogate_key IS NOT NULL OR payload_hash IS NOT NULL").count() == df.where("surrogate_key = 'own' OR surrogate_key IS NULL").count()
        FS.write_silver(df, f"{tmp_dir}/{k}")
        back = spark.read.schema(df.schema).parquet(f"{tmp_dir}/{k}").select(*df.columns)
        assert back.exceptAll(df).count() == 0 and df.exceptAll(back).count() == 0


def test_hashes_are_made_for_rows_of_repeated_keys_alone(spark):
    made = spark.sparkContext.accumulator(0)

    def digest(v):
        made.add(1)
        return f"h{v}"

    df = spark.createDataFrame([(str(k % 95), k) for k in range(100)], "k string, v int").localCheckpoint()
    late = {"payload_hash": F.udf(digest, "string")("v")}
    out = D.keep_one_per_key(df, "k", ["payload_hash"], late, keep=["k", "payload_hash"])
    assert out.columns == ["k", "payload_hash"]
    assert out.select("k").count() == 95 and made.value < 40
    want = {str(k): min(f"h{v}" for v in range(k, 100, 95)) for k in range(95)}
    assert {r.k: r.payload_hash for r in out.collect()} == want
    whole = D.keep_one_per_key(df, "k", ["payload_hash"], late)
    assert whole.columns == ["k", "v", "payload_hash"] and {r.k: r.payload_hash for r in whole.collect()} == want


def test_a_line_is_shuffled_once_for_all_its_geos_and_without_its_key(spark, monkeypatch):
    seen = []
    number = E.number_within
    monkeypatch.setattr(N, "ROWS_A_PARTITION", 40)
    monkeypatch.setattr(E, "number_within", lambda df, *a, **kw: seen.append(df) or number(df, *a, **kw))
    silver = journal.silver_lines(spark, SMOKE_DIR).withColumn(
        "surrogate_key", F.when(F.col("journal_line_num") == 1, F.lit("own")).otherwise(F.col("surrogate_key"))).withColumn(
        "journal_line_num", F.when(F.col("journal_line_num") > 2, F.lit(7)).otherwise(F.col("journal_line_num")))
    lines = silver.where("effective_date >= '1998-06-01'").localCheckpoint()
    geos = ["ASIA", "EUROPE", "ANTARCTICA"]
    out = E.generate(lines, "MONTHLY", geos=geos)
    assert "surrogate_key" not in seen[0].columns and "geo" not in seen[0].columns and seen[0].count() == lines.count()
    w = Window.partitionBy("batch_id", "ledger_source", "geo").orderBy("journal_id", "journal_line_num", "surrogate_key")
    src = lines.withColumn("batch_id", E.batch_id_for("MONTHLY", E.period_end("effective_date", 1)))
    want = E.fan_out(src, geos, ["AP", "AR", "IC"]).withColumn("n", F.row_number().over(w)).select(
        "batch_id", "ledger_source", "geo", "is_fallback", "n", "journal_id", "entered_dr", "description")
    got = out.select("batch_id", "ledger_source", "geo", "is_fallback", F.col("journal_line_num").alias("n"), "journal_id",
                     F.expr("nullif(entered_dr, 0)").alias("entered_dr"), "description")
    assert got.count() > 500 and got.where("is_fallback").count() > 0
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_groups_are_not_made_again_to_count_them(spark, monkeypatch):
    asked = []
    number = P.number_within
    monkeypatch.setattr(P, "number_within", lambda *a, **kw: asked.append(kw.get("partitions")) or number(*a, **kw))
    entries = catalog._entries(spark, SMOKE_DIR, "YEARLY").drop("is_fallback")
    assert P.aggregate_for_period(entries, "YEARLY").count() > 0 and asked[0]


def test_ordinals_go_on_over_the_parts_of_a_folder(spark, tmp_dir):
    root = f"{tmp_dir}/csv"
    rows = spark.range(300).select((F.col("id") % 2).alias("year"), F.col("id").cast("string").alias("journal_id"))
    N.by_range(rows, ["year", "journal_id"]).write.partitionBy("year").option("header", True).option("compression", "gzip").csv(root)
    assert len(glob.glob(f"{root}/year=1/*.gz")) > 1
    got = FS.with_ordinals(FS.read_csv_batch(spark, root, positions=True), folders=True)
    for year in (0, 1):
        of = [r.journal_id for r in got.where(F.col("year") == year).orderBy("row_ordinal").collect()]
        assert of == sorted(str(k) for k in range(300) if k % 2 == year)
    assert got.agg(F.max("row_ordinal")).first()[0] == 150


def test_no_task_writes_a_batch_whole(spark, monkeypatch, tmp_dir):
    monkeypatch.setattr(N, "ROWS_A_PARTITION", 500)
    monkeypatch.setattr(catalog, "_scratch", lambda spark, label: f"{tmp_dir}/ordinals")
    catalog.issue_ordinals(spark, SMOKE_DIR)
    assert len(glob.glob(f"{tmp_dir}/ordinals/year=1995/part-*")) > 1


def test_landing_text_is_not_sorted_by_batch(spark, monkeypatch, tmp_dir):
    """More values than open files too: what Spark sorts then is whole."""
    monkeypatch.setattr(catalog, "_scratch", lambda spark, label: f"{tmp_dir}/{label}")
    held = []
    monkeypatch.setattr(FS, "read_json_batch", lambda spark, path, **kw: held.append(spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")) or READ_JSON(spark, path, **kw))
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    catalog.roundtrip_json_wrapped(spark, SMOKE_DIR)
    assert held == [before]
    df = spark.range(0, 500, 1, 2).select((F.col("id") % 10).alias("batch_id"), F.col("id").cast("string").alias("value"))
    for files in (4, 20):
        with FS.files_open(spark, files):
            plans = _plans_of(spark, lambda: df.write.partitionBy("batch_id").text(f"{tmp_dir}/{files}"))
        assert plans and not any("Sort " in p for p in plans)
        assert sorted(int(r.value) for r in spark.read.text(f"{tmp_dir}/{files}").collect()) == list(range(500))


READ_JSON = FS.read_json_batch


def _plans_of(spark, write):
    """Explained plans of what ``write`` runs, from the status store of its SQL executions."""
    store = spark._jsparkSession.sharedState().statusStore()
    bus = spark.sparkContext._jsc.sc().listenerBus()

    def all_kept():
        bus.waitUntilEmpty()
        rows = store.executionsList()
        return {rows.apply(k).executionId(): rows.apply(k) for k in range(rows.size())}

    # By their ids: the store keeps the last thousand only.
    before = max(all_kept(), default=-1)
    write()
    return [row.physicalPlanDescription() for k, row in sorted(all_kept().items()) if k > before]


def test_headers_are_found_without_a_sort_of_the_lines(spark, tmp_dir):
    for k in range(4):
        with open(f"{tmp_dir}/{k}.csv", "w") as f:
            f.write("\n" * k + ("a,b\n1,2\n" if k % 2 else "b,a\n2,1\n") + "9,9\n" * 50)
    got = []
    plans = _plans_of(spark, lambda: got.append(FS.read_csv_batch(spark, tmp_dir)))
    assert any("min_by" in p for p in plans) and not any("SortAggregate" in p for p in plans)
    assert got[0].where("a = '1' AND b = '2'").count() == 4


def test_json_lines_of_a_file_are_parsed_one_by_one(spark, tmp_dir):
    """A task holds a file's text and one line's objects, not the objects of all lines; nothing is lost or reordered."""
    import json

    with open(f"{tmp_dir}/lines.json", "w") as f:
        f.write("\n".join(["", *[json.dumps({"records": [{"journal_id": f"J{n}"}, None]}) for n in range(30)], "{broken", "[]",
                           json.dumps([{"journal_id": "A"}, {"journal_id": "B"}]), "7"]))
    with open(f"{tmp_dir}/one.json", "w") as f:
        json.dump([{"journal_id": f"D{n}"} for n in range(3)], f, indent=1)
    open(f"{tmp_dir}/empty.json", "w").close()
    df = FS.read_json_batch(spark, tmp_dir, positions=True)
    analyzed = df._jdf.queryExecution().analyzed().toString()
    assert "flatten(" not in analyzed and "explode(" in analyzed
    rows = FS.with_ordinals(df, "n").where("_source_path LIKE '%lines.json'").orderBy("n").select("journal_id").collect()
    assert [r[0] for r in rows] == [*[f"J{n}" for n in range(30)], None, "A", "B", None]
    assert {r[0] for r in df.where("_source_path LIKE '%one.json'").select("journal_id").collect()} == {"D0", "D1", "D2"}


def test_a_sink_makes_its_rows_once_and_clears_batches_without_any(spark, tmp_dir):
    made = spark.sparkContext.accumulator(0)

    def seen(v):
        made.add(1)
        return v

    batches = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "batch_id string")
    for k, names in enumerate((["a", "b"], ["a"])):
        rows = spark.createDataFrame([(b, k) for b in names for _ in range(5)], "batch_id string, v int").select("batch_id", F.udf(seen, "int")("v").alias("v"))
        FS.write_partitioned(rows, f"{tmp_dir}/t", ["batch_id"], batches=batches)
    assert made.value == 15
    assert [tuple(r) for r in spark.read.parquet(f"{tmp_dir}/t").select("batch_id", "v").collect()] == [("a", 1)] * 5
    assert sorted(os.path.basename(x) for x in glob.glob(f"{tmp_dir}/t/batch_id=*")) == ["batch_id=a"]


def test_stage_tables_of_a_lake_table_are_removed_when_it_is_written(spark):
    from fxlake import session

    kept = session.stage_table(spark.range(5), "kept")
    made = []

    def build():
        made.append(session.stage_table(spark.range(7), "made"))
        return made[0]

    table = session.lake_table(spark, "t", os.urandom(8).hex(), build)
    assert table.count() == 7 and kept.count() == 5
    assert not os.path.exists(made[0]._stage) and os.path.exists(kept._stage)
    session.drop_table(kept)
    assert not os.path.exists(kept._stage)


def test_geos_of_lines_come_without_a_lambda_a_line(spark):
    rows = [("x", "AP", None), ("x", "AP", "EU"), ("y", "AP", "EU"), ("y", "AP", "??"), ("z", "AR", "??"), ("z", "XX", None)]
    out = E.with_targets(spark.createDataFrame(rows, "batch_id string, ledger_source string, geo_tag string"), ["EU", "US"], ["AP", "AR"])
    assert "lambda" not in out._jdf.queryExecution().optimizedPlan().toString()
    got = sorted((r.batch_id, str(r.geo_tag), [(t.geo, t.is_fallback) for t in r[E.TARGETS]]) for r in out.collect())
    assert got == [("x", "EU", [("EU", False)]), ("x", "None", [("EU", False), ("US", False)]), ("y", "??", [("US", True)]),
                   ("y", "EU", [("EU", False), ("US", True)]), ("z", "??", [("EU", True), ("US", True)])]


def test_packed_json_is_taken_for_the_text_it_may_hold(spark, tmp_dir):
    lines = spark.range(0, 4000, 1, 1).select(F.format_string('{"journal_id":"J%08d","ledger_id":"a long and even name"}', "id").alias("value"))
    lines.write.option("compression", "gzip").text(f"{tmp_dir}/in")
    size = max(os.path.getsize(f) for f in glob.glob(f"{tmp_dir}/in/*.gz"))
    assert FS._large_files(spark, f"{tmp_dir}/in", 2 * size) and not FS._large_files(spark, f"{tmp_dir}/in", FS.TEXT_A_BYTE * size)
    plan = _plan(FS.read_json_batch(spark, f"{tmp_dir}/in", whole_bytes=2 * size))
    got = [FS.read_json_batch(spark, f"{tmp_dir}/in", whole_bytes=n).select("journal_id", "ledger_id") for n in (2 * size, 1 << 30)]
    assert "json" in plan and got[0].count() == 4000 and got[0].exceptAll(got[1]).count() == 0

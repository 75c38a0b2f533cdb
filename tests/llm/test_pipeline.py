"""The pipeline stage by stage against brute force, each on its predecessor's rows."""

import os
import random

import corpus_pipeline
from fxlake.llm import decontaminate, quality
from tests.llm import test_decontaminate, test_jaccard, test_lines
from tests.llm.conftest import make, prose


def tables(spark, folder, awkward):
    r = random.Random(8)
    passage, shared = prose(901, 60), prose(902, 70)
    good = [(k, f"{prose(k, r.randrange(30, 120))}\n{shared}" if k % 5 == 0 else prose(k, r.randrange(30, 120))) for k in range(20, 120)]
    junk = [(200 + k, " ".join(r.choice(["buy", "now", "$$$", "win"]) + str(r.randrange(99)) for _ in range(60))) for k in range(60)]
    near = [(300 + k, t) for k, t in enumerate(test_jaccard.near_copies(5, 15, 120, 0.04))] + [(330, good[3][1]), (331, good[3][1])]
    dirty = [(400 + k, f"{prose(700 + k, 40)} {passage} {prose(800 + k, 40)}") for k in range(4)] + [(410, passage.upper())]
    make(spark, awkward + good + junk + near + dirty).write.parquet(os.path.join(folder, "documents.parquet"))
    spark.createDataFrame([(d, 1) for d, _ in good[::2]] + [(d, 0) for d, _ in junk[::2]], "doc_id long, quality int").write.parquet(
        os.path.join(folder, "labels.parquet"))
    spark.createDataFrame([(1, passage), (2, None)], "item_id long, text string").write.parquet(os.path.join(folder, "benchmark.parquet"))
    return [(1, passage), (2, None)]


def rows(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_stages_equal_brute_force(spark, tmp_dir, awkward):
    bench = tables(spark, tmp_dir, awkward)
    docs = spark.read.parquet(os.path.join(tmp_dir, "documents.parquet"))
    columns = docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, tmp_dir)
        before = rows(docs)
        if name == "quality_rules":
            model = quality.fit(docs, spark.read.parquet(os.path.join(tmp_dir, "labels.parquet")))
            want = {(r.doc_id, r.kept) for r in quality.judge(docs, model).collect()}
            assert sorted(rows(out), key=str) == sorted((b for b in before if (b[0], True) in want and (b[0], False) not in want), key=str)
            kept = {d for d, _ in rows(out)}
            assert not kept & set(range(200, 260)) and set(range(20, 120)) <= kept
        elif name == "line_dedup":
            cut = test_lines.brute(before)
            assert sorted((d, (t or "").count("\n") + 1 if t else 1) for d, t in rows(out) if d is not None) == sorted(
                (d, max(1, n - gone)) for d, n, gone, _ in cut if d is not None)
            assert any(gone for _, _, gone, _ in cut)
        elif name == "near_duplicates":
            linked = {(d, c) for d, _, c in test_jaccard.brute(before, 5, 80)}
            assert sorted((d for d, _ in rows(out)), key=str) == sorted((d for d, c in linked if d == c or d is None), key=str)
            assert len(rows(out)) < len(before)
        elif name == "decontamination":
            hit = {d for d, n, h, _ in test_decontaminate.brute(before, bench) if h and 20 * h >= n}
            assert sorted((d for d, _ in rows(out)), key=str) == sorted((d for d, _ in before if d not in hit), key=str)
            assert hit
        else:
            assert out.where("NOT lossless").count() == 0 and out.count() == len(before)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == columns
            path = os.path.join(tmp_dir, f"stage{k}")
            out.write.parquet(path)
            docs = spark.read.parquet(path)


def test_run_and_empty_tables(spark, tmp_dir, awkward):
    make(spark, []).write.parquet(os.path.join(tmp_dir, "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int").write.parquet(os.path.join(tmp_dir, "labels.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(os.path.join(tmp_dir, "benchmark.parquet"))
    assert corpus_pipeline.run(spark, tmp_dir).collect() == []


def test_contaminated_rule_is_the_contract(spark):
    frame = spark.createDataFrame([(0, 0), (1, 20), (1, 21), (13, 260), (13, 261)], "n_hit long, n_words long")
    assert [r[0] for r in frame.select(decontaminate.contaminated()).collect()] == [False, True, False, True, False]

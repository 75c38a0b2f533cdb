import hashlib

from fxlake.llm import lines
from tests.llm.conftest import lower, make, prose


def brute(documents):
    holders = {}
    for doc, text in documents:
        for x in (text or "").split("\n"):
            key = lower(x.strip(lines.BLANK))
            if len(key) >= 40:
                holders.setdefault(key, set()).add(lines.NO_ID if doc is None else doc)
    out = []
    for doc, text in documents:
        parts = (text or "").split("\n")
        kept = []
        for x in parts:
            h = holders.get(lower(x.strip(lines.BLANK)), ())
            if len(h) < 5 or (lines.NO_ID if doc is None else doc) == max(h):
                kept.append(x)
        out.append((doc, len(parts), len(parts) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def run(spark, documents):
    frame = make(spark, documents)
    out = lines.apply_bitmaps(frame, lines.keep_bitmaps(frame))
    return sorted(((r["row"].doc_id, r.n_lines, r.n_dropped, hashlib.sha256((r.text or "").encode()).hexdigest()) for r in out.collect()), key=str)


def test_matches_brute_force(spark, awkward):
    common, rare, exact = prose(3, 20), prose(4, 20), "x" * 40
    documents = awkward + [(k, f"{prose(k, 9)}\n  {common.upper() if k % 2 else common}\t\nshort\n{common}") for k in range(100, 160)]
    documents += [(k, rare) for k in range(200, 204)] + [(k, exact) for k in range(300, 305)] + [(k, "x" * 39) for k in range(310, 320)]
    documents += [(304, exact), (None, exact), (304, "y\n" + exact)]
    assert run(spark, documents) == brute(documents)


def test_a_key_over_many_partitions(spark):
    """A line of every document reaches over partition ends."""
    common = prose(3, 20)
    documents = [(k, f"{prose(k, 9)}\n{common}") for k in range(3000)]
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert run(spark, documents) == brute(documents)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_dedup_keeps_columns(spark):
    common = prose(3, 20)
    frame = make(spark, [(k, f"own {k}\n{common}") for k in range(6)] + [(9, None)])
    out = lines.dedup(frame)
    assert out.columns == frame.columns
    assert {r.doc_id: r.text for r in out.collect()} == {**{k: f"own {k}" for k in range(5)}, 5: f"own 5\n{common}", 9: None}


def test_empty_table(spark):
    assert run(spark, []) == []


def test_texts_meet_their_bitmaps_by_the_same_join_at_every_size(spark):
    """A broadcast of few bitmaps would give way to a shuffle of the texts as they grow."""
    frame = make(spark, [(k, prose(3, 20)) for k in range(8)])
    plan = lines.apply_bitmaps(frame, lines.keep_bitmaps(frame))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan

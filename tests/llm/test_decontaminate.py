import re

from fxlake.llm import decontaminate
from tests.llm.conftest import lower, make, prose

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(documents, benchmark):
    windows = {}
    for item, text in benchmark:
        w = WORD.findall(lower(text))
        n = min(13, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[k:k + n]), set()).update([str(item)] if item is not None else [])
    out = []
    for doc, text in documents:
        w = WORD.findall(lower(text))
        hit, items = set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if (found := windows.get(tuple(w[k:k + n]))) is not None:
                    hit.update(range(k, k + n))
                    items |= found
        out.append((doc, len(w), len(hit), tuple(sorted(items))))
    return sorted(out, key=str)


def run(spark, documents, benchmark, **options):
    bench = spark.createDataFrame(benchmark, "item_id long, text string")
    return sorted(((r.doc_id, r.n_words, r.n_hit, tuple(r.item_ids)) for r in
                   decontaminate.scan(make(spark, documents), bench, **options).collect()), key=str)


def test_matches_brute_force(spark, awkward):
    passage = prose(9, 60)
    benchmark = [(10, passage), (2, prose(5, 13)), (3, "two words"), (None, prose(6, 20)), (4, None), (5, ""), (2, "again two"), (11, passage)]
    documents = awkward + [(20, "Before " + passage.upper() + " after"), (21, passage[: len(passage) // 2]), (22, "x two, WORDS! again two words"),
                           (23, prose(6, 20)), (24, prose(5, 12)), (25, "two"), (26, "words"), (27, f"{prose(5, 13)} {prose(5, 13)}")]
    assert run(spark, documents, benchmark) == brute(documents, benchmark)
    # Blocks of a benchmark that is too large for one broadcast give the same.
    assert run(spark, documents, benchmark, block_bytes=200) == brute(documents, benchmark)


def test_empty_tables(spark, awkward):
    assert run(spark, [], [(1, "a b")]) == []
    assert all(r[2] == 0 for r in run(spark, awkward, []))


def test_clean_keeps_columns_and_drops_contaminated(spark):
    passage = prose(9, 60)
    documents = make(spark, [(1, passage), (2, prose(3, 2000) + " " + prose(9, 13)), (3, prose(4, 30)), (4, None)])
    bench = spark.createDataFrame([(1, passage)], "item_id long, text string")
    kept = decontaminate.clean(documents, bench)
    assert kept.columns == documents.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 4]


def test_spans_stay_inside_their_document(spark):
    bench = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    rows = decontaminate.scan(make(spark, [(1, "a b c"), (2, "a b c x a b c")]), bench).collect()
    assert sorted((r.doc_id, [tuple(s) for s in r.hit_spans]) for r in rows) == [(1, [(0, 3)]), (2, [(0, 3), (4, 7)])]

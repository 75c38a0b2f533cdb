import random
import re
from collections import Counter

from fxlake.llm import quality
from tests.llm.conftest import make, prose


def brute(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(tuple(w[k:k + 8]) for k in range(len(w) - 7))
    hit = {p for k in range(len(w) - 7) if windows[tuple(w[k:k + 8])] > 1 for p in range(k, k + 8)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    failed = len(w) < 20 or 100 * len(hit) > 30 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(hit), failed


def test_base_counts(spark, awkward):
    documents = awkward + [(100, "a b c d e f g h " * 5), (101, "x\nx\n\n \n \nx y\nX"), (102, "#*$% <> é | & " + prose(3, 30)),
                           (103, prose(4, 50) + " " + prose(4, 9) + "\n" + prose(4, 9)), (104, prose(5, 19)), (105, prose(5, 20))]
    got = sorted(((r.doc_id, *(r[c] for c in quality.COUNTS), r.base_failed) for r in quality.judge(make(spark, documents), None).collect()), key=str)
    assert got == sorted(((d, *brute(t)) for d, t in documents), key=str)


def corpus(n):
    r = random.Random(3)
    good = [(k, prose(k, r.randrange(40, 200))) for k in range(n)]
    junk = [(1000 + k, " ".join(r.choice(["buy", "now", "click", "$$$", "win", "free", "cash"]) + str(r.randrange(9)) for _ in range(80))) for k in range(n)]
    return good, junk


def test_held_out_accuracy(spark):
    good, junk = corpus(150)
    labels = spark.createDataFrame([(d, 1) for d, _ in good[:100]] + [(d, 0) for d, _ in junk[:100]] + [(None, 1), (5, None), (9999, 0)],
                                   "doc_id long, quality int")
    frame = make(spark, good + junk)
    rows = quality.judge(frame, quality.fit(frame, labels)).collect()
    kept = {r.doc_id for r in rows if r.kept}
    fresh_good, fresh_junk = {d for d, _ in good[100:]}, {d for d, _ in junk[100:]}
    assert len(kept & fresh_good) >= 0.95 * len(fresh_good)
    assert len(kept & fresh_junk) <= 0.1 * len(fresh_junk)


def test_clean_and_missing_labels(spark, awkward):
    frame = make(spark, awkward)
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.fit(frame, none) is None
    assert quality.fit(make(spark, []), none) is None
    kept = quality.clean(frame, none)
    assert kept.columns == frame.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted((d for d, t in awkward if not brute(t)[5]), key=str)
    assert quality.clean(make(spark, []), none).collect() == []

import random
import re
import zlib
from fractions import Fraction

import numpy as np
from hypothesis import given, settings, strategies as st

from fxlake.llm import periods
from tests.llm.conftest import make

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(w, shortest=6, repeats=4):
    """Every maximal stretch of each period; a stretch with a shorter period counts for that one."""
    n, found = len(w), {}
    for q in range(1, n // repeats + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            size = j - i + q
            if size >= max(shortest, repeats * q):
                found.setdefault((i, size), q)
            i = j
    return sorted((s, size, q) for (s, size), q in found.items())


def planted(doc, w):
    h = zlib.crc32(str(doc).encode()) if doc is not None else 1
    if h % 10 or not w:
        return w
    g, n = h // 10, len(w)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def collapsed(w, found):
    lost = {i for s, size, q in found for i in range(s + q, s + size)}
    return " ".join(x for i, x in enumerate(w) if i not in lost)


def of(*texts):
    names = np.array([ord(c) for t in texts for c in t], np.int64)
    return list(zip(*(x.tolist() for x in periods.runs(names, np.cumsum([0, *map(len, texts)])))))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.text("ab", max_size=5), st.integers(1, 9)), max_size=6), st.text("abc", max_size=12))
def test_runs_match_brute_force(parts, tail):
    text = "".join(p * k for p, k in parts) + tail
    assert of(text) == brute(text)


def test_runs_stay_within_their_text():
    assert of("aaa", "aaa", "", "abababab") == [(6, 8, 2)]
    assert of("a" * 5, "a" * 6) == [(5, 6, 1)]
    fibonacci = ["a", "ab"]
    while len(fibonacci[-1]) < 600:
        fibonacci.append(fibonacci[-1] + fibonacci[-2])
    assert of(fibonacci[-1]) == brute(fibonacci[-1])


def test_long_periods():
    r = random.Random(5)
    for q in (7, 8, 9, 63, 64, 65, 200):
        base = [r.randrange(3) for _ in range(q)]
        w = [9] + base * 5 + [8] + base * 3
        names = np.array(w, np.int64)
        assert list(zip(*(x.tolist() for x in periods.runs(names, np.array([0, len(w)]))))) == brute(w)


def test_operator_matches_brute_force(spark, awkward):
    rows = awkward + [(k, " ".join(random.Random(k).choice("ab") * 2 for _ in range(60))) for k in range(100, 130)]
    rows += [(200, "x " * 3000), (201, "one two\tthree\n" * 40 + "end"), (201, "one two\tthree\n" * 40 + "end"), (202, "Ünï 日本 " * 6)]
    frame = make(spark, rows)
    got = periods.find_runs(frame).collect()
    want = {}
    for k, (doc, text) in enumerate(rows):
        w = WORD.findall(text or "")
        found = brute(w) if len(w) < 5000 else None
        want[k] = (doc, w, text, found)
    assert len(got) == len(rows)
    for r in got:
        doc, w, text, found = want[r["row"]["row"]]
        assert (r["row"]["doc_id"], r.n_words) == (doc, len(w))
        mine = [(x.start, x.length, x.period) for x in r.runs]
        if found is None:
            found = [(30000, 5000, 1)]
        assert mine == found
        assert r.collapsed == (None if text is None else collapsed(w, found))


def test_planted_repeats_and_strongest_run(spark):
    rows = [(k, " ".join(f"w{random.Random(k).randrange(40)}{j % 7}" for j in range(k % 90))) for k in range(400)] + [(None, "a b"), (3, None)]
    frame = periods.plant_repeats(make(spark, rows))
    assert frame.columns == ["doc_id", "text"]
    found = periods.find_runs(frame).select("row.doc_id", "runs", periods.strongest(periods.F.col("runs")).alias("best")).collect()
    want = sorted(((d, brute(planted(d, WORD.findall(t or "")))) for d, t in rows), key=str)
    got = sorted(((r.doc_id, [tuple(x) for x in r.runs]) for r in found), key=str)
    assert got == want and any(f for _, f in want)
    for r in found:
        runs = [tuple(x) for x in r.runs]
        best = min(runs, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2])) if runs else None
        assert (tuple(r.best) if r.best else None) == best


def test_empty_table_and_only_a_text_column(spark):
    assert periods.find_runs(make(spark, [])).collect() == []
    one = periods.find_runs(spark.createDataFrame([("a " * 6,)], "text string")).first()
    assert [tuple(x) for x in one.runs] == [(0, 6, 1)] and one.collapsed == "a"

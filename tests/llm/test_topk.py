import math
import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from fxlake.llm import topk

DDL = "vec_id long, embedding array<double>, rank int, score string, q int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "s", 1) for i, v in rows], DDL)


def usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def brute(rows, queries, k=5):
    rows = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and usable(v)]
    queries = [(i, [math.floor(256 * x) for x in v]) for i, v in queries if i is not None and usable(v)]
    out = []
    for i, v in queries:
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in rows if j != i)[:k]
        out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(scored)]
    return sorted(out)


def answer(spark, rows, queries, **kw):
    got = topk.search(frame(spark, rows), frame(spark, queries), **kw)
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got.collect())


def vectors(n, dims=6, seed=1):
    r = random.Random(seed)
    return [(k, [0.0 if r.random() < 0.4 else r.uniform(-1, 1) for _ in range(dims)]) for k in range(n)]


AWKWARD = [(None, [1.0] * 6), (900, None), (901, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (902, [float("nan")] + [1.0] * 5), (903, [float("-inf")] + [1.0] * 5),
           (904, []), (905, [0.5]), (906, [0.1] * 9), (907, [1.0] * 6), (907, [1.0] * 6), (908, [1.0] * 6), (909, [-1 / 512] * 6)]


@pytest.mark.parametrize("blocks", [{}, {"block": 7, "least": 3}, {"block": 50, "least": 1}])
def test_matches_brute_force(spark, blocks):
    rows = vectors(160) + AWKWARD
    queries = [r for r in rows if r[0] is not None and (r[0] % 10 == 0 or r[0] > 900)]
    assert answer(spark, rows, queries, **blocks) == brute(rows, queries)


def test_few_candidates_ties_and_empty(spark):
    rows = [(k, [0.25, 0.5]) for k in range(4)]
    assert answer(spark, rows, rows) == brute(rows, rows)
    assert answer(spark, rows * 3, rows, k=2) == brute(rows * 3, rows, k=2)
    assert answer(spark, rows[:1], rows[:1]) == []
    assert answer(spark, [], rows) == [] and answer(spark, rows, []) == []


def test_wide_weights(spark):
    rows = [(1, [3e4, 1.0]), (2, [-2e5, 7.0]), (3, [1e7, 1e7]), (4, [2.0 ** 30, -2.0 ** 29])]
    small = [(9, [1.5, -2.0])]
    assert answer(spark, rows, small) == brute(rows, small)
    with pytest.raises(Exception, match="too large"):
        answer(spark, [(1, [1e300])], small)


@settings(max_examples=100, deadline=None)
@given(st.integers(0, 10_000), st.sampled_from([20, 2000, 2 ** 40]))
def test_postings_are_exact(seed, size):
    r = np.random.default_rng(seed)
    rows = r.integers(-size, size, (30, 5)) * (r.random((30, 5)) < 0.5)
    asked = r.integers(-size, size, (4, 7))
    kind = topk._score_type(rows, asked)
    postings = topk.Postings(rows, kind)
    for query in asked:
        want = [sum(int(a) * int(b) for a, b in zip(x, query)) for x in rows.tolist()]
        assert [int(x) for x in postings.scores(query)] == want

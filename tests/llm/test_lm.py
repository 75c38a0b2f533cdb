import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from fxlake.llm import lm
from fxlake.llm.text import NOT_SPACE, Words
from tests.llm.conftest import lower, make, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(documents):
    tokens = [WORD.findall(lower(t)) + [None] for _, t in documents]
    held = [zlib.crc32(("" if d is None else str(d)).encode()) % 7 == 2 for d, _ in documents]
    counts = Counter(x for t, h in zip(tokens, held) if not h for x in t)
    n, v = sum(counts.values()), len(counts)
    return [(d, h, len(t), sum(counts[x] > 0 for x in t), n, sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in t))
            for (d, _), t, h in zip(documents, tokens, held)]


def key(row):
    return str(row[0]), row[2], row[3], round(row[5], 6)


@pytest.mark.parametrize("head", [lm.HEAD, 20])
def test_counts_and_base(spark, awkward, head):
    """With a short head most counts arrive by the join."""
    documents = awkward + [(100 + k, prose(k, 50, 30)) for k in range(60)]
    got = sorted(([r.doc, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score] for r in
                  lm.score(make(spark, documents), head=head, updates=2).collect()), key=key)
    want = sorted((list(r) for r in brute(documents)), key=key)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert all(math.isclose(g[5], w[5], rel_tol=1e-9, abs_tol=1e-9) for g, w in zip(got, want))


def plain_model(texts, head, updates):
    """Weights by the definitions, with dictionaries. Returns log10 P(token | context) - log10 of the base as a function."""
    counts = Counter(x for t in texts for x in t)
    n_all, v = sum(counts.values()), len(counts)
    ranks = {x: k for k, x in enumerate(head)}
    kind = lambda x: 0 if x not in ranks else next(c for c in range(1, 7) if ranks[x] < 8 ** c)
    mass = Counter()
    for x in head:
        mass[kind(x)] += counts[x] + 1
    mass[0] = n_all + v + 1 - sum(mass.values())

    def context(before, skipped):
        if before == "START" or before in ranks:
            return before
        return ("skip", skipped) if skipped in ranks else "none"

    def with_contexts(t):
        return [(context(t[k - 1] if k else "START", t[k - 2] if k > 1 else "START"), x) for k, x in enumerate(t)]

    classes, pairs = {}, {}
    for t in texts:
        for c, x in with_contexts(t):
            classes.setdefault(c, Counter())[kind(x)] += 1
            if x in ranks:
                pairs.setdefault((c, kind(x)), Counter())[x] += 1

    def fitted(group, total, base):
        w = dict.fromkeys(group, 0.0)
        for turn in range(updates + 1):
            z = 1 + sum(base[m] * (math.exp(w[m]) - 1) for m in group)
            if turn == updates:
                return w, math.log(z)
            for m, n in group.items():
                e = total * base[m] * math.exp(w[m]) / z
                w[m] += max(-1, min(1, (n - e - lm.PRIOR * w[m]) / (e + lm.PRIOR)))

    class_base = {c: mass[c] / (n_all + v + 1) for c in range(7)}
    class_fit = {c: fitted(g, sum(g.values()), class_base) for c, g in classes.items()}
    pair_fit = {}
    for (c, k), g in pairs.items():
        kept = {x: n for x, n in g.items() if n >= lm.MIN_COUNT}
        if kept:
            pair_fit[c, k] = fitted(kept, classes[c][k], {x: (counts[x] + 1) / mass[k] for x in kept})

    def gain(t):
        total = 0.0
        for c, x in with_contexts(t):
            if c in class_fit:
                w, z = class_fit[c]
                total += w.get(kind(x), 0.0) - z
            if (c, kind(x)) in pair_fit:
                w, z = pair_fit[c, kind(x)]
                total += w.get(x, 0.0) - z
        return total / math.log(10)

    return gain


@pytest.mark.parametrize("head,pair_head", [(lm.HEAD, lm.PAIR_HEAD), (30, 5), (12, 0)])
def test_score_matches_the_definitions(spark, head, pair_head):
    """Short heads: rare tokens and most pairs arrive by the join, skip contexts are used."""
    documents = [(k, prose(k % 37, 40, 2) + (" tail of the text" if k % 3 else "")) for k in range(90)] + [(500, None), (501, "unseen words only")]
    tokens = {d: WORD.findall(lower(t)) + [None] for d, t in documents}
    train = [t for d, t in tokens.items() if zlib.crc32(str(d).encode()) % 7 != 2]
    counts = Counter(x for t in train for x in t)
    names = [x for x in counts if x is not None]
    hashes = dict(zip(names, Words(pa.array([" ".join(names)]), NOT_SPACE).hashes.view(np.int64).tolist()))
    hashes[None] = int(np.array([lm.END]).view(np.int64)[0])
    order = sorted(counts, key=lambda x: (-counts[x], hashes[x]))[:head]
    gain = plain_model(train, order, 6)
    for r in lm.score(make(spark, documents), head=head, updates=6, pair_head=pair_head).collect():
        assert math.isclose(r.score - r.base_score, gain(tokens[r.doc]), rel_tol=1e-5, abs_tol=1e-4), r.doc


def plain_gain(texts, head, known, updates):
    """As plain_model, where words outside the head have weights too; ``known`` says which of them are contexts."""
    counts = Counter(x for t in texts for x in t)
    total = sum(counts.values()) + len(counts) + 1
    ranks = {x: k for k, x in enumerate(head)}
    kind = lambda x: 0 if x not in ranks else next(c for c in range(1, 7) if ranks[x] < 8 ** c)
    mass = Counter()
    for x in head:
        mass[kind(x)] += counts[x] + 1
    mass[0] = total - sum(mass.values())

    def uses(t):
        for k, x in enumerate(t):
            before, skipped = t[k - 1] if k else "START", t[k - 2] if k > 1 else "START"
            if not k or before in ranks:
                yield ("word", before), ("word", before), x
            else:
                skip = ("skip", skipped) if skipped in ranks else ("none",)
                yield skip, ("word", before) if known(before) else skip, x

    classes, within, cells = {}, Counter(), Counter()
    for outer, inner, x in (u for t in texts for u in uses(t)):
        classes.setdefault(outer, Counter())[kind(x)] += 1
        cells[inner, kind(x)] += 1
        within[inner, x] += 1
    groups = {}
    for (c, x), n in within.items():
        if n >= lm.MIN_COUNT:
            groups.setdefault((c, kind(x)), {})[x] = n

    def fitted(group, seen, base):
        w = dict.fromkeys(group, 0.0)
        for turn in range(updates + 1):
            z = 1 + sum(base[m] * (math.exp(w[m]) - 1) for m in group)
            if turn == updates:
                return w, math.log(z)
            for m, n in group.items():
                e = seen * base[m] * math.exp(w[m]) / z
                w[m] += max(-1, min(1, (n - e - lm.PRIOR * w[m]) / (e + lm.PRIOR)))

    class_fit = {c: fitted(g, sum(g.values()), {k: mass[k] / total for k in range(7)}) for c, g in classes.items()}
    word_fit = {c: fitted(g, cells[c], {x: (counts[x] + 1) / mass[c[1]] for x in g}) for c, g in groups.items()}

    def gain(t):
        out = 0.0
        for outer, inner, x in uses(t):
            for fits, c, member in ((class_fit, outer, kind(x)), (word_fit, (inner, kind(x)), x)):
                if c in fits:
                    out += fits[c][0].get(member, 0.0) - fits[c][1]
        return out / math.log(10)

    return gain, sum(c[0] == "word" and c[1] not in ranks and c[1] != "START" or x not in ranks for (c, _), g in groups.items() for x in g)


@pytest.mark.parametrize("table,pair_head", [(30, 5), (12, 0), (12, lm.PAIR_HEAD)])
def test_words_outside_the_head_have_weights(spark, table, pair_head):
    """Only a few words are broadcast: pairs of, and after, all others count as well; words seen once leave the word before them."""
    documents = [(k, prose(k % 37, 40, 2) + f" once{k} after once{k}x twice{k // 2} " + prose(k % 5, 9, 2)) for k in range(120)]
    documents += [(500, None), (501, "unseen words only"), (502, "aa0 unseen ba1 " + prose(3, 40, 2))]
    tokens = {d: WORD.findall(lower(t)) + [None] for d, t in documents}
    train = [t for d, t in tokens.items() if zlib.crc32(str(d).encode()) % 7 != 2]
    counts = Counter(x for t in train for x in t)
    names = list({x for t in tokens.values() for x in t if x is not None})
    hashes = dict(zip(names, Words(pa.array([" ".join(names)]), NOT_SPACE).hashes.view(np.int64).tolist()))
    hashes[None] = int(np.array([lm.END]).view(np.int64)[0])
    order = sorted(counts, key=lambda x: (-counts[x], hashes[x]))[:table]
    floor = counts[order[-1]]
    place = lambda x: int(lm._places(np.array([hashes[x]]), 1)[0])
    bits = {place(x) for x in counts if lm.MIN_COUNT <= counts[x] <= floor}
    gain, rest = plain_gain(train, order, lambda x: place(x) in bits, 6)
    assert rest > 100
    for r in lm.score(make(spark, documents), table=table, updates=6, pair_head=pair_head).collect():
        assert math.isclose(r.score - r.base_score, gain(tokens[r.doc]), rel_tol=1e-5, abs_tol=1e-4), r.doc


def test_texts_of_rare_words_gain_by_being_seen_twice(spark):
    """No word of them is of the head; the copies are trained on, so their pairs are known."""
    trained = [k for k in range(400) if zlib.crc32(str(k).encode()) % 7 != 2]
    rare = " ".join(f"rare{k}" for k in range(30))
    documents = [(k, prose(k, 60, 3)) for k in trained[2:200]] + [(k, rare) for k in trained[:2]]
    got = {r.doc: r for r in lm.score(make(spark, documents), table=100).collect()}
    assert got[trained[0]].score - got[trained[0]].base_score > 0.5 * 29


def test_probabilities_sum_to_one():
    """Of every context, over the head and what stands for all other tokens."""
    r = np.random.default_rng(1)
    size, n_all, vocabulary = 600, 50000, 900
    counts = np.sort(r.integers(1, 80, size))[::-1]
    head = lm.Head(r.permutation(size).astype(np.uint64), counts)
    token_base, class_base = lm.bases(head, n_all, vocabulary)
    assert math.isclose(class_base.sum(), 1)
    kind = lm.class_of(np.arange(size))
    pairs = np.unique(r.integers(0, 40, 4000) << lm.LOW | r.integers(0, size, 4000))
    seen = Counter()
    for k in pairs.tolist():
        seen[k >> lm.LOW, int(kind[k & (1 << lm.LOW) - 1])] += 5
    classes = {(c << lm.LOW | lm.CLASS_KEY | k): n for (c, k), n in seen.items()} | {(c << lm.LOW | lm.CLASS_KEY): 7 for c in range(0, 40, 2)}
    keys = np.array(sorted([*pairs.tolist(), *classes]))
    n = np.array([classes.get(k, 3) for k in keys.tolist()])
    out = dict(zip(*(x.tolist() for x in lm.fit_contexts(keys, n, token_base, class_base)[:2])))
    for c in range(40):
        total = class_base[0] * 10 ** out[c << lm.LOW | lm.CLASS_KEY]
        for t in range(size):
            total += class_base[kind[t]] * token_base[t] * 10 ** (out[c << lm.LOW | lm.CLASS_KEY | int(kind[t])] + out.get(c << lm.LOW | t, 0.0))
        assert math.isclose(total, 1, rel_tol=1e-9)


def test_updates_reach_the_optimum():
    first, n, total = np.array([0, 3]), np.array([50, 20, 2, 9]), np.array([100, 9])
    base = np.array([0.001, 0.2, 0.0001, 1e-6])
    w, z = lm.fit(first, n, total, base, 300)
    mass = np.repeat(total, [3, 1]) * base * np.exp(w) / np.exp(np.repeat(z, [3, 1]))
    assert np.allclose(n - mass - lm.PRIOR * w, 0, atol=1e-3)


def test_contexts_start_anew_in_each_text():
    def found(texts):
        tokens, bounds = lm.token_stream(Words(pa.array(texts, pa.string()), NOT_SPACE))
        places = lm.Head(np.unique(tokens)[:-2] if len(tokens) > 4 else tokens, np.ones(max(len(np.unique(tokens)) - 2, 0), int)).places
        ranks = np.where(places(tokens) >= 0, (tokens % np.uint64(50)).astype(np.int64), -1)
        context = lm.contexts(ranks, bounds, 50)
        return [(context[a:b].tolist(), ranks[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]

    for context, ranks in found(["a b c", "", "b", None, "a b c d", "q q x y z"]):
        alone = lm.contexts(ranks, np.array([0, len(ranks)]), 50).tolist()
        assert context == alone
        assert context[0] == 100


def test_model_grows_with_the_pairs(spark):
    def weights(n):
        frame = make(spark, [(k, prose(k, 60, 40)) for k in range(n)]).select("text")
        tokens = Counter(x for k in range(n) for x in [*prose(k, 60, 40).split(), None])
        names = [x for x in tokens if x]
        keys = Words(pa.array([" ".join(names)]), NOT_SPACE).hashes
        head = lm.Head(np.append(keys, lm.END), np.array([tokens[x] for x in names] + [tokens[None]]))
        return lm.train(frame, head, sum(tokens.values()), len(tokens), 1).pairs.count()

    assert weights(400) > 2 * weights(200) > 0


def test_bitmap_holds_every_key(spark):
    keys = np.random.default_rng(3).integers(0, 1 << 37, 9000)
    marks = lm.mark(spark.createDataFrame([(int(k),) for k in keys], "key long"))
    assert lm.marked(marks, keys).all()
    assert lm.marked(marks, np.arange(1 << 37, (1 << 37) + 10000)).mean() < 0.1
    assert not lm.marked(lm.mark(spark.createDataFrame([], "key long")), keys).any()


def test_text_ids(spark):
    rows = spark.createDataFrame([("x", "a b"), ("7", "a c")], "doc_id string, text string")
    assert sorted((str(r.doc), r.n_tokens) for r in lm.score(rows, updates=1).collect()) == [("7", 3), ("None", 3)]


def test_model_beats_the_base_on_held_out_text(spark):
    """Words follow a fixed order, which only the context features can know."""
    ring = [f"w{k}" for k in range(40)]
    documents = [(k, " ".join(ring[(k + j) % 40] for j in range(60))) for k in range(200)]
    rows = [r for r in lm.score(make(spark, documents)).collect() if r.held_out]
    assert rows
    assert sum(r.score for r in rows) > 0.7 * sum(r.base_score for r in rows)


def test_empty_and_untrained(spark):
    assert lm.score(make(spark, [])).collect() == []
    held = next(k for k in range(100) if zlib.crc32(str(k).encode()) % 7 == 2)
    row, = lm.score(make(spark, [(held, "a b")])).collect()
    assert (row.n_tokens, row.n_known, row.train_tokens, row.base_score) == (3, 0, 0, 0.0)

"""Hashed maximum-entropy language model with a class-factored softmax.

A token's probability is P(class | context) * P(token | class, context). Tokens
are 64-bit hashes of the lower-cased word. The ``HEAD`` most frequent ones have
classes by rank (powers of eight), all others share class 0. A context is one of
two kinds, with features of its own:

* n-gram: the word before, where it is one of the head;
* skip: the word before that, where the word before is not of the head.

The class factor has a weight for every (context, class), the factor within the
class one for every (context, token) seen ``MIN_COUNT`` times or more, whether or
not the token is of the head. Within the class a word outside the head is a context
of its own too, if training text may hold it ``MIN_COUNT`` times: a bitmap
(``known``) holds all such words and lets in few others, which have no weight.
So the model grows with the pairs that the corpus holds. At weight 0 both factors are the add-one frequencies that the base is made of (with
one share for unseen tokens in class 0), and each sums to one.

Training: one pass sums the pairs over all training tokens; the kept ones are
dealt out by context, and each task takes gradient updates of the weights of its
contexts until they are fitted under a Gaussian prior. Contexts share no weight,
so the tasks need not talk to each other; one holds a context's kept pairs.

Scoring adds up sparse weights: class weights (at most contexts x classes) and
the ``PAIR_HEAD`` most frequent pairs are broadcast, as is the head of the
vocabulary; all other pairs and counts are joined, once a text. A bitmap of the
kept pairs (``BITS_A_PAIR`` bits each, up to ``BUCKETS`` x 4 KB) turns away pairs
without a weight before the join; it lets all that have one through.

Cases: null and empty text is one end token; a null id counts as the empty
string in the split; repeated rows are counted and scored each; without
training rows every count is zero and the base is log10(1) = 0 a token. Ids are
cast to long: a text id that is no number gives a null ``doc``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fxlake.llm.text import NOT_SPACE, U64, Words, mix, released, slices, small_batches
from fxlake.session import stage_table

HEAD = 1 << 17
PAIR_HEAD = 1 << 17
CLASSES = 7
MIN_COUNT = 2
UPDATES = 24
FOLDS, HELD_FOLD = 7, 2
PRIOR = 0.05

END = np.uint64(0x656E642D746F6B65)
START = np.uint64(0x73746172742D746F)
FLUSH = 1 << 20
BITS_A_PAIR, BUCKETS, BUCKET_BITS = 16, 1 << 14, 1 << 15
#: A key holds a context above these bits; below is a head token's rank, or 2^17 and a class (for uses of the class factor alone: and 8).
LOW = 18
CLASS_KEY = 1 << 17
CLASS_ALONE = CLASS_KEY | 8
#: Rows with a word (else 0): a token outside the head after a context (key: the context and REST), or, where the key is itself a word
#: outside the head, what follows it: 1 and the class, RANK and the rank, or a word. Names of words and of their weights have the top bit.
REST, RANK = CLASS_KEY | 16, 16
TOP = U64(1 << 63)


def fold(id_col: str) -> F.Column:
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % FOLDS


def class_of(rank: np.ndarray) -> np.ndarray:
    """Classes of ranks: 1 for the first 8, 2 up to 64, ..., 6; 0 for no rank (-1)."""
    return np.where(rank < 0, 0, 1 + np.searchsorted(8 ** np.arange(1, CLASSES - 1), rank, "right"))


class Head:
    """The most frequent tokens: hashes in order, ranks and counts."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        """``keys`` by falling frequency."""
        order = np.argsort(keys)
        self.keys, self.rank, self.counts = keys[order], order.astype(np.int32), counts[order]

    def places(self, tokens: np.ndarray) -> np.ndarray:
        """Places in ``keys``, -1 where a token is not of the head."""
        if not len(self.keys):
            return np.full(len(tokens), -1)
        at = np.minimum(np.searchsorted(self.keys, tokens), len(self.keys) - 1)
        return np.where(self.keys[at] == tokens, at, -1)

    def ranks(self, places: np.ndarray) -> np.ndarray:
        return np.where(places < 0, -1, self.rank[places]) if len(self.keys) else places

    @property
    def contexts(self) -> int:
        """n-gram contexts, then skip contexts, then the start of a text, then neither word known."""
        return 2 * len(self.keys) + 2


def token_stream(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """All tokens with an end after each text, and the ranges of the texts."""
    n_docs = len(words.bounds) - 1
    bounds = words.bounds + np.arange(n_docs + 1)
    tokens = np.empty(bounds[-1], U64)
    tokens[np.arange(len(words.hashes)) + words.doc] = words.hashes
    tokens[bounds[1:] - 1] = END
    return tokens, bounds


def contexts(ranks: np.ndarray, bounds: np.ndarray, size: int) -> np.ndarray:
    """The context of every token, for a head of ``size`` tokens."""
    before, skipped = np.full(len(ranks), -1, np.int64), np.full(len(ranks), -1, np.int64)
    before[1:], skipped[2:] = ranks[:-1], ranks[:-2]
    second = bounds[:-1] + 1
    skipped[second[second < bounds[1:]]] = -1
    out = np.where(before >= 0, before, np.where(skipped >= 0, size + skipped, 2 * size + 1))
    out[bounds[:-1]] = 2 * size
    return out


def owned(tokens: np.ndarray, ranks: np.ndarray, bounds: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each token is a known word outside the head, and whether the token before it in its text is one."""
    rest = np.zeros(len(tokens), bool)
    at = np.flatnonzero(ranks < 0)
    rest[at] = marked(known, tokens[at].view(np.int64))
    after = np.zeros(len(tokens), bool)
    after[1:] = rest[:-1]
    after[bounds[:-1]] = False
    return rest, after


def _word(tokens: np.ndarray) -> np.ndarray:
    return (tokens | TOP).view(np.int64)


def _name(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The key of a weight of a context and a word, one of which is outside the head."""
    return _word(mix(mix(context.view(U64)) + word.view(U64)))


def _follows(tokens: np.ndarray, ranks: np.ndarray, at: np.ndarray, rest: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of the tokens at ``at``, all after a known word outside the head: that word, the class, and which of them have a word (and it)."""
    has = (ranks[at] >= 0) | rest[at]
    held = at[has]
    return (_word(tokens[at - 1]), 1 + class_of(ranks[at]), has, np.where(ranks[held] >= 0, RANK + ranks[held], _word(tokens[held])))


def _sums(parts, names):
    """Sums of counts by key over (keys, counts) of many slices, flushed as they grow."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0

    def merged():
        keys = np.concatenate([k for k, _ in held])
        total = np.concatenate([n for _, n in held])
        order = np.argsort(keys, kind="stable")
        keys, total = keys[order], total[order]
        first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        return keys[first], np.add.reduceat(total, first)

    def rows(keys, total):
        for at in range(0, len(keys), 1 << 16):
            k, n = keys[at: at + (1 << 16)], total[at: at + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(k.view(np.int64)), pa.array(n)], names)

    for part in parts:
        held.append(part)
        size += len(part[0])
        if size > FLUSH:
            held = [merged()]
            size = len(held[0][0])
            if size > FLUSH // 2:
                yield from rows(*held[0])
                held, size = [], 0
    if size:
        yield from rows(*merged())


@released
def _count_tokens(batches):
    yield from _sums((np.unique(token_stream(Words(b.column(0), NOT_SPACE))[0], return_counts=True) for b in slices(batches, "text")), ["key", "n"])


def _keys(ranks: np.ndarray, context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of (context, class) for all tokens, and of (context, token) where the token has a rank (else -1)."""
    high = context << LOW
    return high | CLASS_KEY | class_of(ranks), np.where(ranks < 0, -1, high | ranks)


@released
def _count_pairs(batches, shared):
    head, known = shared.value
    aside = []

    def parts():
        for b in slices(batches, "text"):
            tokens, bounds = token_stream(Words(b.column(0), NOT_SPACE))
            ranks = head.ranks(head.places(tokens)).astype(np.int64)
            context = contexts(ranks, bounds, len(head.keys))
            classes, pairs = _keys(ranks, context)
            rest, after = owned(tokens, ranks, bounds, known)
            follows, new = np.flatnonzero(after), np.flatnonzero(rest & ~after)
            word, kind, has, next_word = _follows(tokens, ranks, follows, rest)
            aside.append((np.concatenate((context[new] << LOW | REST, word, word[has])),
                          np.concatenate((_word(tokens[new]), kind, next_word))))
            yield np.unique(np.concatenate((classes, classes[follows] | 8, pairs[(pairs >= 0) & ~after])), return_counts=True)

    def rows():
        while aside:
            keys, words = aside.pop()
            if len(keys):
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(words), pa.array(np.ones(len(keys), np.int64))], ["key", "word", "n"])

    for b in _sums(parts(), ["key", "n"]):
        yield from rows()
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.zeros(b.num_rows, np.int64)), b.column(1)], ["key", "word", "n"])
    yield from rows()


def fit(first: np.ndarray, n: np.ndarray, total: np.ndarray, base: np.ndarray, updates: int = UPDATES) -> tuple[np.ndarray, np.ndarray]:
    """Weights of softmax groups and the logarithms of their sums, by gradient updates.

    Group g holds the members from ``first[g]``, was seen ``total[g]`` times and
    has base probabilities that sum to one with what no member covers; ``n`` and
    ``base`` are per member. A member's probability is base * exp(weight) / sum.
    """
    w = np.zeros(len(n))
    if not len(n):
        return w, np.zeros(0)
    size = np.diff(np.concatenate((first, [len(n)])))
    seen = np.repeat(total, size).astype(float)
    log_sum = np.zeros(len(first))
    for _ in range(updates + 1):
        raised = base * np.exp(w)
        log_sum = np.log(np.maximum(1 + np.add.reduceat(raised - base, first), 1e-300))
        if _ == updates:
            break
        mass = seen * raised * np.exp(-np.repeat(log_sum, size))
        w += np.clip((n - mass - PRIOR * w) / (mass + PRIOR), -1, 1)
    return w, log_sum


def fit_contexts(keys: np.ndarray, n: np.ndarray, token_base: np.ndarray, class_base: np.ndarray, updates: int = UPDATES,
                 words: np.ndarray | None = None, word_base: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys, weights and counts of whole contexts, from counts sorted by key and word: per context a row of every class, and its pairs.

    ``word_base`` is the probability within class 0 of words outside the head.
    Rows of CLASS_ALONE hold, for contexts other than n-grams, the part of the classes'
    weights that belongs to the factor within the class: after a known word it is not used.
    """
    if words is None:
        words, word_base = np.zeros(len(keys), np.int64), np.zeros(len(keys))
    context, low = keys >> LOW, keys & ((1 << LOW) - 1)
    is_class = (words == 0) & (low >= CLASS_KEY) & (low < CLASS_ALONE)
    # Class factor.
    held, kind = context[is_class], low[is_class] - CLASS_KEY
    names, first = np.unique(held, return_index=True)
    a, log_sum = fit(first, n[is_class], np.add.reduceat(n[is_class], first) if len(first) else first, class_base[kind], updates)
    table = np.zeros((len(names), CLASSES))
    row = np.searchsorted(names, held)
    table[row, kind] = a
    table -= log_sum[:, None]
    # Within the class; ranks of a class follow each other, words outside the head are all of class 0.
    used = np.zeros(table.shape, np.int64)
    used[row, kind] = n[is_class]
    alone = (words == 0) & (low >= CLASS_ALONE)
    used[np.searchsorted(names, context[alone]), low[alone] - CLASS_ALONE] -= n[alone]
    inner = np.zeros(table.shape)
    pairs, rest = (words == 0) & (low < CLASS_KEY), (words != 0) & (keys >= 0)
    found = [np.zeros(0), np.zeros(0)]
    for k, (which, kinds, base) in enumerate(((pairs, class_of(low[pairs]), token_base[low[pairs]]), (rest, np.zeros(rest.sum(), np.int64), word_base[rest]))):
        cells, begins = np.unique(context[which] * CLASSES + kinds, return_index=True)
        at = np.searchsorted(names, cells // CLASSES), cells % CLASSES
        found[k], log_sum = fit(begins, n[which], used[at], base, updates)
        inner[at] -= log_sum
    table += inner
    split = np.flatnonzero((names >= len(token_base)) & inner.any(axis=1))
    every, apart = (((names[of] << LOW)[:, None] | mark | np.arange(CLASSES)[None, :]).ravel() for of, mark in ((slice(None), CLASS_KEY), (split, CLASS_ALONE)))
    # After a word outside the head: rows of a class, and what was seen in it.
    own = keys < 0
    names, place = np.unique(keys[own], return_inverse=True)
    word, times = words[own], n[own]
    total = (word > 0) & (word < RANK)
    follow = ~total
    ranks = np.where(word[follow] < 0, -1, word[follow] - RANK)
    cell = place[follow] * CLASSES + class_of(ranks)
    cells, begins = np.unique(cell, return_index=True)
    spot = np.searchsorted(place[total] * CLASSES + word[total] - 1, cells)
    base = np.where(ranks < 0, word_base[own][follow], token_base[np.maximum(ranks, 0)] if len(token_base) else 0.0)
    w, log_sum = fit(begins, times[follow], times[total][spot], base, updates)
    return (np.concatenate((every, apart, keys[pairs], _name(context[rest], words[rest]), _name(names[place[follow]], word[follow]),
                            _name(names[cells // CLASSES], cells % CLASSES + 1))),
            np.concatenate((table.ravel(), inner[split].ravel(), *found, w, -log_sum)) / np.log(10),
            np.concatenate((np.zeros(len(every) + len(apart), np.int64), n[pairs], n[rest], times[follow], times[total][spot])))


@released
def _fit(batches, shared, updates):
    """Weights of a partition's contexts; rows come sorted by key and word, every context whole."""
    token_base, class_base, rest_mass = shared.value
    held = [np.zeros(0, np.int64)] * 4

    def done(upto):
        if upto:
            keys, words, n, count = (x[:upto] for x in held)
            out = fit_contexts(keys, n, token_base, class_base, updates, words, (count + 1) / rest_mass)
            for at in range(0, len(out[0]), 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(x[at: at + (1 << 16)]) for x in out], ["key", "weight", "n"])

    for b in batches:
        if b.num_rows:
            held = [np.concatenate((x, b.column(k).to_numpy())) for k, x in enumerate(held)]
            last = held[0][-1]
            upto = int(np.searchsorted(held[0], last >> LOW << LOW if last >= 0 else last))
            yield from done(upto)
            held = [x[upto:] for x in held]
    yield from done(len(held[0]))


_DOC = pa.struct([("doc", pa.int64()), ("held", pa.bool_()), ("n_tokens", pa.int64()), ("known", pa.int64()), ("logs", pa.float64()),
                  ("context", pa.float64())])
#: A text has one row with ``doc`` (its key is ``at``, ``pair`` is null), and one for each count or weight to be looked up.
_ROW = ("at long, pair boolean, key long, times int, "
        "doc struct<doc:long,held:boolean,n_tokens:long,known:long,logs:double,context:double>")


def _distinct(doc: np.ndarray, pair: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct (doc, pair, key) and how often each occurs."""
    order = np.lexsort((key, pair, doc))
    d, p, k = doc[order], pair[order], key[order]
    first = np.flatnonzero(np.concatenate(([True], (k[1:] != k[:-1]) | (p[1:] != p[:-1]) | (d[1:] != d[:-1])))) if len(k) else np.zeros(0, int)
    return d[first], p[first], k[first], np.diff(np.concatenate((first, [len(k)]))).astype(np.int32)


@released
def _read(batches, shared):
    head, known, table, inner, pair_keys, pair_weights, marks = shared.value
    logs = np.append(np.log10(head.counts + 1.0), 0.0)
    for b in slices(batches, "text"):
        tokens, bounds = token_stream(Words(b.column(3), NOT_SPACE))
        places = head.places(tokens)
        ranks = head.ranks(places).astype(np.int64)
        context = contexts(ranks, bounds, len(head.keys))
        _, pairs = _keys(ranks, context)
        rest, after = owned(tokens, ranks, bounds, known)
        kind = class_of(ranks)
        weight = table[context, kind].astype(float)
        follows, new, plain = np.flatnonzero(after), np.flatnonzero(rest & ~after), np.flatnonzero((pairs >= 0) & ~after)
        weight[follows] -= inner[context[follows], kind[follows]]
        word, kinds, has, next_word = _follows(tokens, ranks, follows, rest)
        at = np.concatenate((plain, new, follows, follows[has]))
        keys = np.concatenate((pairs[plain], _name(context[new], _word(tokens[new])), _name(word, kinds), _name(word[has], next_word)))
        n_docs = b.num_rows
        doc = np.repeat(np.arange(n_docs), np.diff(bounds))
        context_sum = np.bincount(doc, weight, n_docs)
        if len(pair_keys):
            spot = np.minimum(np.searchsorted(pair_keys, keys), len(pair_keys) - 1)
            common = pair_keys[spot] == keys
            context_sum += np.bincount(doc[at[common]], pair_weights[spot[common]], n_docs)
            at, keys = at[~common], keys[~common]
        rare, hit = np.flatnonzero(places < 0), marked(marks, keys)
        at, keys = at[hit], keys[hit]
        ids = b.column(0)
        of, pair, key, times = _distinct(np.concatenate((doc[rare], doc[at])), np.repeat([False, True], [len(rare), len(at)]),
                                         np.concatenate((tokens[rare].view(np.int64), keys)))
        told = pa.StructArray.from_arrays(
            [b.column(1), b.column(2), pa.array(np.diff(bounds), pa.int64()), pa.array(np.bincount(doc, places >= 0, n_docs).astype(np.int64)),
             pa.array(np.bincount(doc, logs[places], n_docs)), pa.array(context_sum)], fields=list(_DOC))
        for columns in ([ids, pa.nulls(n_docs, pa.bool_()), ids, pa.nulls(n_docs, pa.int32()), told],
                        [ids.take(pa.array(of)), pa.array(pair), pa.array(key), pa.array(times), pa.nulls(len(of), _DOC)]):
            yield pa.RecordBatch.from_arrays(columns, ["at", "pair", "key", "times", "doc"])


def _places(keys: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(keys.view(U64)) % U64(buckets * BUCKET_BITS)).astype(np.int64)


def marked(marks: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether each key's bit is set."""
    at = _places(keys, len(marks) * 8 // BUCKET_BITS)
    return marks[at >> 3] >> (at & 7) & 1 == 1


def mark(keys: DataFrame) -> np.ndarray:
    """A bitmap of the keys (one column), built by aggregates; its size grows with their number up to ``BUCKETS``."""
    buckets, wanted = 1, BITS_A_PAIR * keys.count()
    while buckets < BUCKETS and buckets * BUCKET_BITS < wanted:
        buckets *= 2

    def places(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(_places(b.column(0).to_numpy(), buckets) + 1)], ["at"])

    rows = (keys.mapInArrow(places, "at long").groupBy(F.bitmap_bucket_number("at").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits")).toArrow())
    out = np.zeros((buckets, BUCKET_BITS // 8), np.uint8)
    for bucket, bits in zip(rows["bucket"].to_pylist(), rows["bits"].to_pylist()):
        out[bucket - 1] = np.frombuffer(bits, np.uint8)
    return out.ravel()


class Model:
    """Head of the vocabulary, bitmap of the other known words, class weights, the part of them that is of the factor within the
    class, pair weights (a stored table), their head and their bitmap."""

    def __init__(self, head: Head, known: np.ndarray, table: np.ndarray, inner: np.ndarray, pairs: DataFrame, pair_keys: np.ndarray,
                 pair_weights: np.ndarray, marks: np.ndarray):
        self.head, self.known, self.table, self.inner, self.pairs = head, known, table, inner, pairs
        self.pair_keys, self.pair_weights, self.marks = pair_keys, pair_weights, marks


def bases(head: Head, n_all: int, vocabulary: int) -> tuple[np.ndarray, np.ndarray]:
    """Add-one probability of each head token (by rank) within its class, and of each class."""
    counts = np.empty(len(head.keys), np.int64)
    counts[head.rank] = head.counts
    kind = class_of(np.arange(len(counts)))
    mass = np.bincount(kind, counts + 1.0, CLASSES)
    mass[0] = n_all + vocabulary + 1 - mass.sum()
    return (counts + 1.0) / mass[kind], mass / (n_all + vocabulary + 1)


def train(texts: DataFrame, head: Head, n_all: int, vocabulary: int, updates: int = UPDATES, pair_head: int = PAIR_HEAD,
          rest: DataFrame | None = None) -> Model:
    """The model of all training texts (one column, ``text``). ``rest``: words outside the head to have weights (key, n)."""
    spark = texts.sparkSession
    token_base, class_base = bases(head, n_all, vocabulary)
    known = np.zeros(BUCKET_BITS // 8, np.uint8) if rest is None else mark(rest.select("key"))
    words = spark.sparkContext.broadcast((head, known))
    base = spark.sparkContext.broadcast((token_base, class_base, class_base[0] * (n_all + vocabulary + 1)))
    is_class = (F.col("key") >= 0) & (F.col("key").bitwiseAND(CLASS_KEY) != 0)
    counted = (texts.mapInArrow(lambda b: _count_pairs(b, words), "key long, word long, n long").groupBy("key", "word").agg(F.sum("n").alias("n"))
               .where((F.col("word") == 0) & is_class | (F.col("n") >= MIN_COUNT)))
    none = F.lit(0).cast("long").alias("count")
    if rest is None:
        counted = counted.select("*", none)
    else:
        # Counts are positive: as the conditions name n, both sides read the same grouped rows, which are made once.
        named = rest.groupBy(F.col("key").bitwiseOR(F.lit(-1 << 63)).alias("word")).agg(F.sum("n").alias("count"))
        counted = counted.where("least(word, n) >= 0").select("*", none).unionByName(
            counted.where("least(word, n) < 0").join(named, "word", "left").select("key", "word", "n", "count"))
    context = F.when(F.col("key") < 0, F.col("key")).otherwise(F.shiftright("key", LOW))
    fitted = stage_table(counted.repartition(context).sortWithinPartitions("key", "word")
                         .mapInArrow(lambda b: _fit(b, base, updates), "key long, weight double, n long"), "lm-weights")
    # At most contexts x classes rows, twice.
    rows = fitted.where(is_class).select("key", F.col("weight").cast("float").alias("weight")).toArrow()
    keys, weights = rows["key"].to_numpy(), rows["weight"].to_numpy()
    low = keys & (CLASS_KEY - 1)
    table, inner = np.zeros((2, head.contexts, CLASSES), np.float32)
    for out, which, less in ((table, low < 8, 0), (inner, low >= 8, 8)):
        out[keys[which] >> LOW, low[which] - less] = weights[which]
    pairs = fitted.where(~is_class)
    top = pairs.orderBy(F.desc("n"), "key").limit(pair_head).select("key", "weight").toArrow()
    order = np.argsort(top["key"].to_numpy())
    return Model(head, known, table, inner, pairs, top["key"].to_numpy()[order], top["weight"].to_numpy()[order], mark(pairs.select("key")))


def score(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", head: int | None = None,
          updates: int = UPDATES, pair_head: int = PAIR_HEAD, table: int = HEAD) -> DataFrame:
    """Per row: doc, held_out, n_tokens, n_known, train_tokens, base_score and score (log10).

    ``head``: how many of the most frequent tokens have weights in pairs (None: all of them; ``table``, which are broadcast, then have classes by rank).
    """
    spark = documents.sparkSession
    small_batches(spark)
    body = documents.select(F.monotonically_increasing_id().alias("at"), F.col(id_col).try_cast("long").alias("doc"), (fold(id_col) == HELD_FOLD).alias("held"),
                            F.col(text_col).cast("string").alias("text"))
    texts = body.where(~F.col("held")).select("text")
    tokens = stage_table(texts.mapInArrow(_count_tokens, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")), "lm-tokens")
    n_all, vocabulary = tokens.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    top = tokens.orderBy(F.desc("n"), "key").limit(min(table if head is None else head, HEAD)).select("key", "n").toArrow()
    counts = top["n"].to_numpy()
    floor = int(counts.min()) if len(counts) else 0
    rest = tokens.where((F.col("n") >= MIN_COUNT) & (F.col("n") <= floor)) if head is None else None
    model = train(texts, Head(top["key"].to_numpy().view(np.uint64), counts), n_all, vocabulary, updates, pair_head, rest)
    shared = spark.sparkContext.broadcast((model.head, model.known, model.table, model.inner, model.pair_keys, model.pair_weights, model.marks))
    read = body.mapInArrow(lambda b: _read(b, shared), _ROW)
    # What the broadcast heads do not answer: counts of rare tokens, weights of rare pairs.
    known = (tokens.where(F.col("n") <= floor).select(F.lit(False).alias("pair"), "key", F.log10(F.col("n") + 1).alias("value"))
             .unionByName(model.pairs.select(F.lit(True).alias("pair"), "key", F.col("weight").alias("value"))))
    times, word = F.col("times"), ~F.col("pair")
    zero, told = F.lit(0.0), [F.max(f"doc.{c}").alias(c) for c in ("doc", "held", "n_tokens", "known", "logs", "context")]
    found = F.col("value").isNotNull()
    sums = (read.join(known, ["key", "pair"], "left").groupBy("at")
            .agg(*told, F.sum(F.when(word & found, times)).alias("more"), F.sum(F.when(word, times * F.col("value"))).alias("more_logs"),
                 F.sum(F.when(~word, times * F.col("value"))).alias("more_weights")))
    base = F.col("logs") + F.coalesce("more_logs", zero) - F.col("n_tokens") * float(np.log10(n_all + vocabulary + 1))
    return sums.select(
        "doc", F.col("held").alias("held_out"), "n_tokens", (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(n_all).cast("long").alias("train_tokens"), base.alias("base_score"),
        (base + F.col("context") + F.coalesce("more_weights", zero)).alias("score"))

"""Quality rules: base counts, and a calibrated logistic regression over hashed n-grams.

Features are hashed words, word pairs and byte 4-grams, each
family as shares of its own total. The model is fitted on a bounded sample of
labelled rows (``SAMPLE_PER_CLASS`` of each class, by hash order), calibrated
on the part of the sample that was not fitted, and applied to every row in
Arrow batches against the fixed threshold ``KEEP_AT``.

Cases: null and empty text has no words and fails the base rule; labels without
a class or a document are left out, and a document with both classes counts as
low quality; without both classes in the labels only the base rule decides;
repeated rows are judged each on its own.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from fxlake.llm.text import NOT_SPACE, U64, Words, mix, per_text, released, slices, small_batches

BUCKETS = 1 << 16
SAMPLE_PER_CLASS = 1500
KEEP_AT = 0.2
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8
SCALE, ROUNDS, RATE, DECAY = 20.0, 120, 0.5, 1e-4

SYMBOLS = np.zeros(256, bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True
BLANK = " \t\n\x0b\x0c\r"

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_SCHEMA = ", ".join(f"{c} long" for c in COUNTS) + ", base_failed boolean, p_good double, kept boolean"


@dataclass
class Model:
    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def probability(self, z: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * z + self.shift, -50, 50)))


def features(words: Words) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per family the feature of each occurrence, and the range of each text."""
    unigrams = (words.hashes >> U64(48)).astype(np.int64)
    at, pairs = words.windows(2)
    data, offsets = words.data, words.offsets
    sizes = np.diff(offsets)
    if len(data) >= 4:
        d = data.astype(np.uint32)
        code = (d[:-3] << np.uint32(24)) | (d[1:-2] << np.uint32(16)) | (d[2:-1] << np.uint32(8)) | d[3:]
        grams = (code * np.uint32(2654435761) >> np.uint32(16)).astype(np.int64)
        inside = np.arange(len(grams)) + 4 <= np.repeat(offsets[1:], sizes)[: len(grams)]
        grams = grams[inside]
    else:
        grams = np.zeros(0, np.int64)
    gram_bounds = np.concatenate(([0], np.cumsum(np.maximum(sizes - 3, 0))))
    return [(unigrams, words.bounds), ((pairs >> U64(48)).astype(np.int64) + BUCKETS, np.searchsorted(at, words.bounds)),
            (grams + 2 * BUCKETS, gram_bounds)]


def margins(words: Words, model: Model) -> np.ndarray:
    z = np.full(len(words.bounds) - 1, model.bias)
    for idx, bounds in features(words):
        z += SCALE * per_text(model.weights[idx].astype(np.float64), bounds) / np.maximum(1, np.diff(bounds))
    return z


@released
def _sparse_rows(batches):
    """(good, held, features, values) of labelled texts."""
    for b in slices(batches, "text"):
        families = features(Words(b.column(0), NOT_SPACE, lower=False))
        idx, val = [], []
        for k in range(b.num_rows):
            parts = [np.unique(f[bounds[k]: bounds[k + 1]], return_counts=True) for f, bounds in families]
            idx.append(np.concatenate([u for u, _ in parts]).astype(np.int32).tobytes())
            val.append(np.concatenate([SCALE * c / max(1, c.sum()) for _, c in parts]).astype(np.float32).tobytes())
        yield pa.RecordBatch.from_arrays([b.column(1), b.column(2), pa.array(idx, pa.binary()), pa.array(val, pa.binary())],
                                         ["good", "held", "idx", "val"])


def fit(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        sample_per_class: int = SAMPLE_PER_CLASS) -> Model | None:
    """The model of a bounded sample of labelled rows; None if a class has no rows."""
    small_batches(documents.sparkSession)
    known = (labels.select(F.col("doc_id").alias("_id"), "quality").where("_id is not null and quality is not null")
             .groupBy("_id").agg(F.min("quality").alias("good")))
    order = F.xxhash64("_id")
    picked = [known.where(c).orderBy(order, "_id").limit(sample_per_class) for c in ("good = 0", "good <> 0")]
    sample = picked[0].unionByName(picked[1]).select("_id", (F.col("good") != 0).cast("int").alias("good"),
                                                     (F.pmod(order, F.lit(4)) == 0).alias("held"))
    # At most 2 * sample_per_class ids.
    rows = (documents.select(F.col(id_col).alias("_doc"), F.col(text_col).alias("text"))
            .join(F.broadcast(sample), F.col("_doc") == F.col("_id")).dropDuplicates(["_id"]).select("text", "good", "held")
            .mapInArrow(_sparse_rows, "good int, held boolean, idx binary, val binary").toArrow())
    good = rows["good"].to_numpy().astype(float)
    held = rows["held"].to_numpy(zero_copy_only=False).astype(bool)
    idx = [np.frombuffer(x, np.int32) for x in rows["idx"].to_pylist()]
    val = [np.frombuffer(x, np.float32) for x in rows["val"].to_pylist()]
    if not len(good) or min(good.sum(), (1 - good).sum()) == 0:
        return None
    if min(good[~held].sum(), (1 - good)[~held].sum()) == 0:
        held[:] = False
    return _train(good, held, idx, val)


def _train(good, held, idx, val) -> Model:
    width = 3 * BUCKETS
    take = np.flatnonzero(~held)
    cols, x = np.concatenate([idx[k] for k in take]), np.concatenate([val[k] for k in take])
    row = np.repeat(np.arange(len(take)), [len(idx[k]) for k in take])
    y = good[take]
    weight = np.where(y == 1, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum()))
    w, bias = np.zeros(width), 0.0
    m, v, mb, vb = np.zeros(width), np.zeros(width), 0.0, 0.0
    for t in range(1, ROUNDS + 1):
        z = np.bincount(row, w[cols] * x, minlength=len(y)) + bias
        err = weight * (1 / (1 + np.exp(-np.clip(z, -50, 50))) - y)
        g = np.bincount(cols, err[row] * x, minlength=width) + DECAY * w
        gb = err.sum()
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        a, c = 1 - 0.9 ** t, 1 - 0.99 ** t
        w -= RATE * (m / a) / (np.sqrt(v / c) + 1e-6) * 0.1
        bias -= RATE * (mb / a) / (np.sqrt(vb / c) + 1e-8) * 0.1
    model = Model(w.astype(np.float32), bias, 1.0, 0.0)
    rest = np.flatnonzero(held) if held.any() else take
    z = np.array([float(model.weights[idx[k]] @ val[k]) for k in rest]) + bias
    model.slope, model.shift = _platt(z, good[rest])
    return model


def _platt(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a probability over margins, with both classes weighed alike."""
    up, down = y.sum(), (1 - y).sum()
    if min(up, down) == 0:
        return 1.0, 0.0
    target = np.where(y == 1, (up + 1) / (up + 2), 1 / (down + 2))
    weight = np.where(y == 1, 0.5 / up, 0.5 / down)
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -50, 50)))
        g = np.array([(weight * (p - target) * z).sum(), (weight * (p - target)).sum()])
        s = weight * p * (1 - p)
        h = np.array([[(s * z * z).sum() + 1e-6, (s * z).sum()], [(s * z).sum(), s.sum() + 1e-6]])
        step = np.linalg.solve(h, g)
        a, b = a - np.clip(step[0], -2, 2), b - np.clip(step[1], -5, 5)
    return max(a, 1e-3), b


def base_counts(words: Words, texts: list[str | None]) -> dict[str, np.ndarray]:
    data, offsets = words.data, words.offsets
    lead = words.mask & ((data & 0xC0) != 0x80)
    at, hashes = words.windows(WINDOW)
    key = mix(hashes + mix(words.doc[at].astype(U64) + U64(1)))
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(at), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    cover = np.zeros(len(words.starts) + 1, np.int64)
    cover[at[twice]] += 1
    cover[at[twice] + WINDOW] -= 1
    dup = []
    for text in texts:
        seen: set[str] = set()
        n = 0
        for line in (text or "").split("\n"):
            if line in seen:
                n += 1
            elif line.strip(BLANK):
                seen.add(line)
        dup.append(n)
    return {"n_words": words.counts, "word_chars": per_text(lead, offsets), "n_symbols": per_text(SYMBOLS[data], offsets),
            "n_dup_lines": np.array(dup, np.int64), "n_repeat_words": per_text(np.cumsum(cover[:-1]) > 0, words.bounds)}


def _judged(text: pa.Array, fitted: Model | None) -> list[pa.Array]:
    """The columns of ``_SCHEMA`` for an array of texts."""
    words = Words(text, NOT_SPACE, lower=False)
    counts = base_counts(words, text.to_pylist())
    failed = (counts["n_words"] < MIN_WORDS) | (100 * counts["n_repeat_words"] > MAX_REPEAT_PERCENT * counts["n_words"])
    p = fitted.probability(margins(words, fitted)) if fitted else np.ones(len(text))
    return [*(pa.array(counts[c], pa.int64()) for c in COUNTS), pa.array(failed), pa.array(p), pa.array(~failed & (p >= KEEP_AT))]


def judge(documents: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``id_col``, the base counts, ``base_failed``, ``p_good`` and ``kept``."""
    small_batches(documents.sparkSession)
    shared = documents.sparkSession.sparkContext.broadcast(model)
    df = documents.select(id_col, F.col(text_col).alias("text"))
    schema = StructType([df.schema[id_col], *StructType.fromDDL(_SCHEMA).fields])

    @released
    def run(batches):
        for b in slices(batches, "text"):
            yield pa.RecordBatch.from_arrays([b.column(0), *_judged(b.column(1), shared.value)], schema.names)

    return df.mapInArrow(run, schema)


def clean(documents: DataFrame, labels: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The documents that the rules and the model keep, with all their columns."""
    shared = documents.sparkSession.sparkContext.broadcast(fit(documents, labels, text_col=text_col, **options))
    at = documents.columns.index(text_col)
    # Names may clash in any way: columns go by place.
    plain = documents.toDF(*[f"c{k}" for k in range(len(documents.columns))])

    @released
    def run(batches):
        for b in slices(batches, f"c{at}"):
            yield b.filter(_judged(b.column(at), shared.value)[-1])

    return plain.mapInArrow(run, plain.schema).toDF(*documents.columns)

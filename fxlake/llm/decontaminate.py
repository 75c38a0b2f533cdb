"""Benchmark decontamination: broadcast n-gram hashes, scan windows, verify hits.

The benchmark is read in blocks of at most ``BLOCK_BYTES`` of text. Each block
becomes one broadcast index (sorted window hashes and the words behind them),
and the documents stream through one scan per block, without a shuffle. A hit
of the hash is verified word by word before it counts.

Cases: null or empty text has no words; a null ``item_id`` marks words but is
in no list of items; rows that share an ``item_id`` are one item; repeated
document rows are judged each on its own; an empty benchmark hits nothing.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fxlake.llm.text import ALNUM, Words, per_text, slices, small_batches

WINDOW = 13
BLOCK_BYTES = 8 << 20

SCAN_SCHEMA = "n_words long, n_hit long, item_ids array<string>, hit_spans array<struct<start:int,end:int>>"


def blocks(benchmark: DataFrame, limit: int = BLOCK_BYTES) -> list[DataFrame]:
    """The benchmark in as many parts, dealt by a hash of the row, as its checked size asks for."""
    rows = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").where("text is not null")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = int(size // limit) + 1
    if n == 1:
        return [rows]
    return [rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(2 * n)) == k) for k in range(2 * n)]


def build_index(rows: pa.Table, window: int = WINDOW) -> dict:
    """Per window length: sorted hashes, the span of words behind each, and the items (as CSR)."""
    table = rows.combine_chunks()
    col = table.column("text").chunk(0) if table.num_rows else pa.array([], pa.string())
    words = Words(col, ALNUM)
    flat, starts, ends = words.compact()
    names = table.column("item_id").to_pylist()
    counts = words.counts
    by_length = {}
    for n in sorted({*np.minimum(counts, window).tolist()} - {0}):
        at, hashes = words.windows(n)
        doc = words.doc[at]
        own = np.minimum(counts[doc], window) == n
        at, hashes, doc = at[own], hashes[own], doc[own]
        spans: dict[tuple[int, bytes], list] = {}
        for k, h, d in zip(at.tolist(), hashes.tolist(), doc.tolist()):
            key = (h, flat[starts[k]: ends[k + n - 1]].tobytes())
            spans.setdefault(key, []).append(names[d])
        keys = sorted(spans)
        by_length[n] = (np.array([h for h, _ in keys], np.uint64), [g for _, g in keys],
                        [sorted({x for x in spans[k] if x is not None}) for k in keys])
    return by_length


def _scan(batch: pa.RecordBatch, column: str, index: dict) -> tuple[np.ndarray, np.ndarray, list[set], list]:
    """Words and hit words of each row, the items found in it, and the covered word ranges."""
    words = Words(batch.column(batch.schema.get_field_index(column)), ALNUM)
    cover = np.zeros(len(words.starts) + 1, np.int64)
    items: list[set] = [set() for _ in range(batch.num_rows)]
    flat = None
    for n, (hashes, texts, names) in index.items():
        at, found = words.windows(n)
        where = np.minimum(np.searchsorted(hashes, found), len(hashes) - 1)
        hits = np.flatnonzero(hashes[where] == found)
        if not len(hits):
            continue
        if flat is None:
            out, starts, ends = words.compact()
            flat, doc = out.tobytes(), words.doc
        for k, w in zip(at[hits].tolist(), where[hits].tolist()):
            seen = flat[starts[k]: ends[k + n - 1]]
            h, ok = hashes[w], False
            while w < len(hashes) and hashes[w] == h:
                if texts[w] == seen:
                    items[doc[k]].update(names[w])
                    ok = True
                w += 1
            if ok:
                cover[k] += 1
                cover[k + n] -= 1
    hit = np.cumsum(cover[:-1]) > 0
    edge = np.diff(np.concatenate(([0], hit.astype(np.int8), [0])))
    edge_doc = words.bounds[1:-1]
    inner = np.unique(edge_doc[(edge_doc > 0) & (edge_doc < len(hit))])
    cut = inner[hit[inner] & hit[inner - 1]]
    begins = np.sort(np.concatenate((np.flatnonzero(edge == 1), cut)))
    stops = np.sort(np.concatenate((np.flatnonzero(edge == -1), cut)))
    owner = np.searchsorted(words.bounds, begins, "right") - 1
    spans: list[list] = [[] for _ in range(batch.num_rows)]
    for a, b, d in zip(begins.tolist(), stops.tolist(), owner.tolist()):
        base = int(words.bounds[d])
        spans[d].append((a - base, b - base))
    return words.counts, per_text(hit, words.bounds), items, spans


def _merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(b, out[-1][1])
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def scan(documents: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         window: int = WINDOW, block_bytes: int = BLOCK_BYTES, keep: bool = False) -> DataFrame:
    """Per row: its words, words inside occurrences, the items found and the covered word ranges.

    Returns ``id_col`` (or with ``keep`` the struct ``row`` of all columns but
    the text, and ``text``) and the columns of ``SCAN_SCHEMA``.
    """
    spark = documents.sparkSession
    small_batches(spark)
    others = [c for c in documents.columns if c != text_col] if keep else [id_col]
    row = F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in others])
    df = documents.select(row.alias("row"), F.col(text_col).alias("text"), F.lit(0).cast("long").alias("n_words"),
                          F.lit(0).cast("long").alias("n_hit"), F.array().cast("array<string>").alias("item_ids"),
                          F.array().cast("array<struct<start:int,end:int>>").alias("hit_spans"))
    schema = df.schema
    parts = blocks(benchmark, block_bytes)
    for block in parts:
        index = spark.sparkContext.broadcast(build_index(block.toArrow(), window))

        def run(batches, index=index, more=keep or block is not parts[-1]):
            for b in slices(batches, "text"):
                counts, _, items, spans = _scan(b, "text", index.value)
                had_items, had_spans = b.column(4).to_pylist(), b.column(5).to_pylist()
                ids = [sorted(i.union(h)) for i, h in zip(items, had_items)]
                all_spans = [_merge(s + [(x["start"], x["end"]) for x in h]) for s, h in zip(spans, had_spans)]
                yield pa.RecordBatch.from_arrays([
                    b.column(0), b.column(1) if more else pa.nulls(b.num_rows, b.schema.field(1).type), pa.array(counts, pa.int64()),
                    pa.array([sum(y - x for x, y in s) for s in all_spans], pa.int64()),
                    pa.array(ids, pa.list_(pa.string())),
                    pa.array([[{"start": x, "end": y} for x, y in s] for s in all_spans], b.schema.field(5).type),
                ], schema=b.schema)

        df = df.mapInArrow(run, schema)
    first = ["row", "text"] if keep else [F.col("row").getField(id_col).alias(id_col)]
    return df.select(*first, "n_words", "n_hit", "item_ids", "hit_spans")


def contaminated() -> F.Column:
    """The rule: some word is hit, and at least one word in twenty."""
    return (F.col("n_hit") > 0) & (F.col("n_hit") * 20 >= F.col("n_words"))


def clean(documents: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The documents that are not contaminated, with all their columns."""
    kept = scan(documents, benchmark, text_col=text_col, keep=True, **options).where(~contaminated())
    return kept.select(*[F.col("text").alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in documents.columns])

"""Periodic runs of words, found with the dictionary of basic factors.

For each power of two L a name stands for every stretch of L words that occurs
again in its text; the names for 2L come from pairs of names for L, so a factor
that does not recur is never looked at again. At level L each start is followed
to the next start with the same name. Successors at a constant distance form
an arithmetic progression; a distance within twice the length proposes a
period. A period of more than L words is left to the next level, where the
factor covers it whole: there consecutive starts with one distance d <= L
extend to words that keep period d, the first and last of them included, and
no shorter period exists (Fine and Wilf). One of at most L / 2 words was
answered by an earlier level, so every run comes out once.

All texts of a slice are worked through together with sorts of numpy arrays;
words are compared exactly (a dictionary of their bytes), not by a hash.

Cases: a null text stays null and has no words and no runs; an empty or blank
one has none either; a text of one repeated word is one run of period 1;
repeated rows are answered each; other columns pass through in ``row``; an
empty table gives no rows. A text is never cut, so a task holds some arrays as
long as the longest text of its partition has words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from fxlake.llm.text import NOT_SPACE, Words, slices, small_batches

SHORTEST, REPEATS = 6, 4

RUN = StructType([StructField(name, LongType()) for name in ("start", "length", "period")])


def word_names(words: Words) -> np.ndarray:
    """A number per word, equal for equal bytes."""
    ends = np.cumsum(words.ends - words.starts)
    offsets = np.concatenate((np.zeros(1, np.int64), ends)).astype(np.int64)
    data = np.ascontiguousarray(words.data[words.mask])
    column = pa.Array.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    return column.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)


def _dense(keys: np.ndarray) -> np.ndarray:
    return np.unique(keys, return_inverse=True)[1].astype(np.int64)


def runs(names: np.ndarray, bounds: np.ndarray, shortest: int = SHORTEST, repeats: int = REPEATS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of every run of the texts ``names[bounds[k]:bounds[k + 1]]``, by start and period; starts count from names[0]."""
    n, counts = len(names), np.diff(bounds)
    end = np.repeat(bounds[1:], counts)
    # Equal words of two texts have different names: no factor is followed into another text.
    name = _dense(np.repeat(np.arange(len(counts)), counts) * (int(names.max(initial=0)) + 1) + names)
    at, length = np.arange(n), 1
    longest = int(counts.max(initial=0)) // repeats
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    while len(at) > 1 and length < 2 * longest:
        order = np.argsort(name[at], kind="stable")
        place = at[order]
        key = name[place]
        same = key[1:] == key[:-1]
        gap = place[1:] - place[:-1]
        near = same & (gap <= 2 * length)
        # Periods that this level is the first to cover whole.
        own = near & (gap <= length) & (2 * gap > length)
        if own.any():
            distance = np.zeros(n, np.int64)
            distance[place[:-1][own]] = gap[own]
            starts = np.flatnonzero(distance)
            period = distance[starts]
            new = np.ones(len(starts), bool)
            new[1:] = (starts[1:] != starts[:-1] + 1) | (period[1:] != period[:-1])
            first = np.flatnonzero(new)
            last = np.append(first[1:], len(starts)) - 1
            size = starts[last] - starts[first] + length + period[first]
            enough = size >= np.maximum(shortest, repeats * period[first])
            found.append((starts[first][enough], size[enough], period[first][enough]))
        again = np.zeros(len(place), bool)
        again[1:] |= same
        again[:-1] |= same
        held = np.full(n, -1, np.int64)
        held[place[again]] = name[place[again]]
        at = np.flatnonzero(held >= 0)
        at = at[at + 2 * length <= end[at]]
        at = at[held[at + length] >= 0]
        name = held
        if len(at):
            pairs = held[at] * (int(held.max()) + 1) + held[at + length]
            name = np.full(n, -1, np.int64)
            name[at] = _dense(pairs)
        length *= 2
    if not found:
        return (np.zeros(0, np.int64),) * 3
    start, size, period = (np.concatenate([f[k] for f in found]) for k in range(3))
    order = np.lexsort((period, start))
    return start[order], size[order], period[order]


def _collapsed(words: Words, dropped: np.ndarray) -> list[str]:
    """The texts' words that stay, joined by one space."""
    data, starts, ends = words.compact()
    body = memoryview(data)
    lost = np.concatenate(([0], np.cumsum(dropped)))
    out = []
    for a, z in zip(words.bounds[:-1].tolist(), words.bounds[1:].tolist()):
        if a == z:
            out.append("")
        elif lost[a] == lost[z]:
            out.append(str(body[starts[a]: ends[z - 1]], "utf-8"))
        else:
            keep = np.flatnonzero(~dropped[a:z]) + a
            out.append(str(b" ".join([body[x:y] for x, y in zip(starts[keep].tolist(), ends[keep].tolist())]), "utf-8"))
    return out


def _find(batches: Iterator[pa.RecordBatch], shortest: int, repeats: int) -> Iterator[pa.RecordBatch]:
    for b in slices(batches, "text"):
        words = Words(b.column(1), NOT_SPACE, lower=False)
        start, size, period = runs(word_names(words), words.bounds, shortest, repeats) if len(words.starts) else (np.zeros(0, np.int64),) * 3
        change = np.zeros(len(words.starts) + 1, np.int64)
        np.add.at(change, start + period, 1)
        np.add.at(change, start + size, -1)
        dropped = np.cumsum(change[:-1]) > 0
        text = np.searchsorted(words.bounds, start, "right") - 1
        offsets = np.searchsorted(start, words.bounds)
        lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(
            [pa.array(start - words.bounds[text]), pa.array(size), pa.array(period)], ["start", "length", "period"]))
        collapsed = pa.array(_collapsed(words, dropped), pa.string())
        if b.column(1).null_count:
            none = pa.nulls(b.num_rows, pa.string())
            collapsed = pc.if_else(b.column(1).is_null(), none, collapsed)
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(words.counts, pa.int64()), lists, collapsed],
                                         ["row", "n_words", "runs", "collapsed"])


def find_runs(documents: DataFrame, text_col: str = "text", shortest: int = SHORTEST, repeats: int = REPEATS) -> DataFrame:
    """Per row: ``row`` (its columns but the text), n_words, ``runs`` by start and period, and ``collapsed``, the text
    without the words that any run holds after its first period (kept words are joined by one space)."""
    small_batches(documents.sparkSession)
    others = [F.col(f"`{c}`") for c in documents.columns if c != text_col]
    body = documents.select((F.struct(*others) if others else F.struct(F.lit(0).alias("_"))).alias("row"), F.col(f"`{text_col}`").cast("string").alias("text"))
    schema = StructType([body.schema["row"]]).add("n_words", "long").add("runs", ArrayType(RUN)).add("collapsed", "string")
    return body.mapInArrow(lambda b: _find(b, shortest, repeats), schema)


def strongest(found: Column) -> Column:
    """The run with the greatest length / period of runs ordered by start and period (the first of equals); null without one."""
    none = F.lit(None).cast(RUN)
    better = lambda best, r: best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"])
    return F.aggregate(found, none, lambda best, r: F.when(better(best, r), r).otherwise(best))


def _plant(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches, "text"):
        words = Words(b.column(1), NOT_SPACE, lower=False)
        data, starts, ends = words.compact()
        body = memoryview(data)
        texts = b.column(1).to_pylist()
        for k, h in enumerate(b.column(2).to_pylist()):
            first, n = int(words.bounds[k]), int(words.counts[k])
            if h is None or h % 10 or not n:
                continue
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            source = np.arange(n)
            source[a:] = a + np.arange(n - a) % p
            source += first
            texts[k] = str(b" ".join([body[x:y] for x, y in zip(starts[source].tolist(), ends[source].tolist())]), "utf-8")
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], ["row", "text"])


def plant_repeats(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and ``text_col`` with a periodic tail in about a tenth of the texts, chosen by the checksum of the id (none for a null id)."""
    small_batches(documents.sparkSession)
    one = F.col(id_col)
    body = documents.select(F.struct(one).alias("row"), F.col(text_col).alias("text"), F.crc32(one.cast("string").cast("binary")).alias("h"))
    schema = StructType([body.schema["row"]]).add("text", "string")
    return body.mapInArrow(_plant, schema).select(F.col("row").getField(id_col).alias(id_col), F.col("text").alias(text_col))

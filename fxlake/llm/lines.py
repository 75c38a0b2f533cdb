"""Line dedup: keys range-partitioned with a secondary sort, streamed, answered with keep bitmaps.

Every line with a key of at least ``MIN_POINTS`` code points gives one narrow
row (key digest, document, position). These rows are range-partitioned by (key,
document), so a line that a third of the documents hold spreads over many
partitions, and sorted by key, document from the largest down, and position. A
task then streams its partition: the first document of a key is the one that
keeps it. Only the first and the last key of a partition can reach into another
one; their rows wait, and their counts (two rows a partition at most) are
combined and broadcast. Text is not shuffled for this; the answer is one zlib
bitmap per document that loses lines.

Cases: null and empty text is one empty line; a null id counts as one document
below all others; rows that share an id count as one document, and each row
gets the bitmap of its own text; an empty table gives empty results.
"""

from __future__ import annotations

import zlib
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fxlake.llm.marks import with_marks
from fxlake.llm.text import released, small_batches
from fxlake.session import stage_table

MIN_POINTS = 40
MIN_DOCS = 5
BLANK = " \t\n\x0b\x0c\r"
NO_ID = -(1 << 63)

_LINE = "key binary, doc long, row long, pos int, n_lines int"
_STREAM = _LINE + ", state int, n_docs long, max_doc long"
DROP, OPEN, COUNT = 1, 2, 3


def line_key(line: str) -> bytes | None:
    """The digest of a line's key; None for keys that are too short."""
    key = line.strip(BLANK)
    return blake2b(key.encode().lower(), digest_size=16).digest() if len(key) >= MIN_POINTS else None


@released
def _keys(batches):
    for b in batches:
        out: list[list] = [[], [], [], [], []]
        for doc, row, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
            lines = (text or "").split("\n")
            for pos, line in enumerate(lines):
                if key := line_key(line):
                    for col, x in zip(out, (key, doc, row, pos, len(lines))):
                        col.append(x)
        if out[0]:
            types = (pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)],
                                             ["key", "doc", "row", "pos", "n_lines"])


class _Run:
    """The rows of one key in a partition, as far as they must wait for the count of documents."""

    def __init__(self, key: bytes, is_first: bool, min_docs: int):
        self.key, self.is_first, self.min_docs = key, is_first, min_docs
        self.max_doc, self.last_doc, self.n_docs, self.waiting = None, None, 0, []

    def add(self, row: tuple, out: list) -> None:
        _, doc, *_ = row
        if doc != self.last_doc:
            self.n_docs += 1
            self.last_doc = doc
            if self.max_doc is None:
                self.max_doc = doc
        if self.is_first:
            out.append((*row, OPEN, None, None))
        elif doc != self.max_doc:
            if self.n_docs >= self.min_docs:
                out.extend((*w, DROP, None, None) for w in self.waiting)
                self.waiting = []
                out.append((*row, DROP, None, None))
            else:
                self.waiting.append(row)

    def close(self, out: list, is_last: bool) -> None:
        if self.is_first or is_last:
            if not self.is_first and self.n_docs < self.min_docs:
                out.extend((*w, OPEN, None, None) for w in self.waiting)
            out.append((self.key, None, None, None, None, COUNT, self.n_docs, self.max_doc))


@released
def _stream(batches, min_docs: int):
    schema = pa.schema([("key", pa.binary()), ("doc", pa.int64()), ("row", pa.int64()), ("pos", pa.int32()),
                        ("n_lines", pa.int32()), ("state", pa.int32()), ("n_docs", pa.int64()), ("max_doc", pa.int64())])
    run: _Run | None = None
    first = True
    out: list[tuple] = []
    for b in batches:
        for row in zip(*(c.to_pylist() for c in b.columns)):
            if run is None or row[0] != run.key:
                if run is not None:
                    run.close(out, False)
                run = _Run(row[0], first, min_docs)
                first = False
            run.add(row, out)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out), schema)], schema=schema)
            out = []
    if run is not None:
        run.close(out, True)
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out), schema)], schema=schema)


def _doc_key(id_col: str) -> F.Column:
    return F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID))


def keep_bitmaps(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = MIN_DOCS) -> DataFrame:
    """One row per document that loses lines: doc, row (hash of its text), n_lines, n_dropped, keep_bitmap.

    ``keep_bitmap`` is zlib-compressed, one bit a line, most significant bit
    first. Documents without a row keep every line.
    """
    small_batches(documents.sparkSession)
    rows = documents.select(_doc_key(id_col).alias("doc"), F.xxhash64(text_col).alias("row"), F.col(text_col).alias("text"))
    keys = stage_table(rows.mapInArrow(_keys, _LINE), "line-keys")
    ordered = (keys.repartitionByRange("key", F.col("doc").desc())
               .sortWithinPartitions("key", F.col("doc").desc(), "pos"))
    seen = stage_table(ordered.mapInArrow(lambda b: _stream(b, min_docs), _STREAM), "line-runs")
    frequent = (seen.where(F.col("state") == COUNT).groupBy("key")
                .agg(F.sum("n_docs").alias("n_docs"), F.max("max_doc").alias("max_doc"))
                .where(F.col("n_docs") >= min_docs).select("key", F.col("max_doc").alias("keeper")))
    lose = ["doc", "row", "pos", "n_lines"]
    # At most two counts a partition exist, whatever the input holds.
    late = (seen.where(F.col("state") == OPEN).join(F.broadcast(frequent), "key")
            .where(F.col("doc") < F.col("keeper")).select(*lose))
    dropped = seen.where(F.col("state") == DROP).select(*lose).unionByName(late)
    per_doc = dropped.groupBy("doc", "row").agg(F.max("n_lines").alias("n_lines"), F.collect_set("pos").alias("lost"))

    def pack(batches):
        for b in batches:
            n_lines, lost = b.column(2).to_pylist(), b.column(3).to_pylist()
            maps = []
            for n, gone in zip(n_lines, lost):
                keep = np.ones(n, bool)
                keep[gone] = False
                maps.append(zlib.compress(np.packbits(keep).tobytes()))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(map(len, lost), pa.int32()),
                                              pa.array(maps, pa.binary())],
                                             ["doc", "row", "n_lines", "n_dropped", "keep_bitmap"])

    return stage_table(per_doc.mapInArrow(pack, "doc long, row long, n_lines int, n_dropped int, keep_bitmap binary"), "bitmaps")


def keep_flags(bitmap: bytes, n_lines: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8), count=n_lines).astype(bool)


def apply_bitmaps(documents: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``documents`` as a struct ``row``, the text that stays, its lines before and the lines dropped."""
    maps = bitmaps.select(F.col("doc").alias("_d"), F.col("row").alias("_r"), "n_dropped", "keep_bitmap")
    body = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns if c != text_col]).alias("row"),
                            F.col(text_col).alias("text"), _doc_key(id_col).alias("_doc"), F.xxhash64(text_col).alias("_row"))
    # Texts that lose nothing stay where they are; the others meet their bitmaps.
    marked = with_marks(body, bitmaps.select("doc", "row"), F.col("_doc"), F.col("_row"))
    # The bitmaps grow with the input, so they are never collected for a broadcast: the plan is the same at every size.
    met = marked.where("_marked").drop("_marked").join(maps.hint("merge"), (F.col("_doc") == F.col("_d")) & (F.col("_row") == F.col("_r")), "left")
    whole = marked.where("NOT _marked").drop("_marked").withColumns({"n_dropped": F.lit(None).cast("int"), "keep_bitmap": F.lit(None).cast("binary")})
    joined = (met.select(*whole.columns).union(whole)
              .select("row", "text", F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"), "keep_bitmap"))
    schema = joined.select("row", "text", F.lit(0).cast("long").alias("n_lines"), "n_dropped").schema

    @released
    def cut(batches):
        for b in batches:
            texts, n_lines = b.column(1).to_pylist(), []
            for k, (text, bitmap) in enumerate(zip(texts, b.column(3).to_pylist())):
                n_lines.append((text or "").count("\n") + 1)
                if bitmap is not None:
                    keep = keep_flags(bitmap, n_lines[-1])
                    texts[k] = "\n".join(x for x, stays in zip(text.split("\n"), keep) if stays)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, b.schema.field(1).type),
                                              pa.array(n_lines, pa.int64()), b.column(2)], ["row", "text", "n_lines", "n_dropped"])

    return joined.mapInArrow(cut, schema)


def dedup(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = MIN_DOCS) -> DataFrame:
    """The documents with the lines that stay; all columns, in their order."""
    out = apply_bitmaps(documents, keep_bitmaps(documents, id_col, text_col, min_docs), id_col, text_col)
    return out.select(*[F.col("text").alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in documents.columns])

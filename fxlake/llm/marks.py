"""Tables of ``2**BITS`` byte counters, summed over tasks in parts; their size does not depend on the input.

``with_marks`` is a bitmap set that may say yes to a few others: rows that it
turns away need no join, so their texts stay out of a shuffle.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

BITS, PART = 22, 14


def parts(counts: np.ndarray):
    """The parts of a table of counters that hold anything, clipped to a byte each; small counts, so packed they are less than half."""
    rows = counts.reshape(-1, 1 << PART)
    used = np.flatnonzero(rows.any(axis=1))
    for at in range(0, len(used), 32):
        yield pa.RecordBatch.from_arrays(
            [pa.array(used[at: at + 32], pa.int32()),
             pa.array([zlib.compress(np.minimum(rows[k], 255).astype(np.uint8).tobytes(), 1) for k in used[at: at + 32]], pa.binary())], ["part", "counts"])


def _sum_parts(batches):
    """Sums of each part of the table, on a scale of 8 steps a power of two; rows come sorted by part."""
    part, total = None, None

    def done():
        code = np.round(8 * np.log2(1.0 + total)).astype(np.uint8).tobytes()
        return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([code], pa.binary())], ["part", "counts"])

    for b in batches:
        for k, counts in zip(b.column(0).to_pylist(), b.column(1)):
            if k != part:
                if part is not None:
                    yield done()
                part, total = k, np.zeros(1 << PART, np.int64)
            total += np.frombuffer(zlib.decompress(counts.as_py()), np.uint8)
    if part is not None:
        yield done()


def summed(rows: DataFrame) -> np.ndarray:
    """Sums of tables of counters, ``2**BITS`` bytes whatever the input holds."""
    rows = rows.repartition("part").sortWithinPartitions("part").mapInArrow(_sum_parts, "part int, counts binary").toArrow()
    codes = np.zeros(1 << BITS, np.uint8)
    for k, counts in zip(rows["part"].to_pylist(), rows["counts"].to_pylist()):
        codes[k << PART: (k + 1) << PART] = np.frombuffer(counts, np.uint8)
    return codes


#: Bits a member, and the most buckets of 32,768 bits (16 MB): past some 10^7 members more rows than needed are marked.
BITS_A_MEMBER, BUCKETS = 16, 1 << 12


def with_marks(df: DataFrame, members: DataFrame, doc: Column, row: Column, name: str = "_marked") -> DataFrame:
    """``df`` with a boolean ``name``: true for every row of ``members`` (doc, row) and for few others.

    A bitmap that grows with ``members`` up to ``BUCKETS`` is built by aggregates
    and broadcast, so rows that it turns away need no join. A null doc counts as -1.
    """
    buckets = 1
    while buckets < BUCKETS and buckets << 15 < BITS_A_MEMBER * members.count():
        buckets *= 2

    def place(doc: Column, row: Column) -> Column:
        return F.pmod(F.xxhash64(F.coalesce(doc, F.lit(-1).cast("long")), row), F.lit(buckets << 15)) + 1

    bucket, bits, at = (f"{name}_{k}" for k in ("bucket", "bits", "at"))
    held = place(F.col("doc"), F.col("row"))
    table = members.groupBy(F.bitmap_bucket_number(held).alias(bucket)).agg(F.bitmap_construct_agg(F.bitmap_bit_position(held)).alias(bits))
    spot = place(doc, row)
    met = (df.withColumns({bucket: F.bitmap_bucket_number(spot), at: F.bitmap_bit_position(spot).cast("int")})
           .join(F.broadcast(table), bucket, "left"))
    byte = F.conv(F.hex(F.expr(f"substring(`{bits}`, cast(`{at}` div 8 + 1 as int), 1)")), 16, 10).cast("int")
    hit = F.expr(f"`{at}` % 8")
    return met.select(*[F.col(f"`{c}`") for c in df.columns], F.coalesce(F.pmod(F.floor(byte / F.pow(F.lit(2), hit)), F.lit(2)) == 1, F.lit(False)).alias(name))

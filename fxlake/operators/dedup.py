"""Keyed de-duplication (W6), duplicate reports (W3, A11) and idempotency.

De-duplication is a grouped ``min`` of the row rather than a ``row_number`` window: the
aggregate runs a partial (map-side) step, so a key that holds a third of all rows
is reduced to one row per input partition before the shuffle and never lands in
one task as a whole.

Only rows whose key may occur again are grouped at all. ``with_repeats`` counts
8-byte digests of the keys and marks those rows; the others are the only row of
their key and go on without a sort or a shuffle of their columns. Columns that
only order the rows of a key (``late``) are computed for the repeated ones alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fxlake.session import stage_table

#: Bits a repeated digest, the most buckets of 32,768 bits (64 MB), and the bytes of a broadcast piece of one.
BITS_A_KEY, BUCKETS, PIECE = 32, 1 << 14, 128


def with_repeats(df: DataFrame, keys: list[str | Column], name: str = "_again") -> DataFrame:
    """``df`` with a boolean ``name``: true for every row whose key occurs more than once, and for few others.

    Digests that occur again are set in a bitmap that grows with their number up
    to ``BUCKETS``; it is built by aggregates and broadcast. Past some 1.7 x 10^7
    repeated keys there are fewer than ``BITS_A_KEY`` bits for each and more rows than needed are marked. Nulls are a key like any other.
    """
    digest = F.xxhash64(*keys)
    seen = df.select(digest.alias("digest")).groupBy("digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("digest")
    seen = stage_table(seen, "repeats")
    n = seen.count()
    if not n:
        return df.withColumn(name, F.lit(False))
    buckets = 1
    while buckets < BUCKETS and buckets << 15 < BITS_A_KEY * n:
        buckets *= 2

    def place(of: Column) -> Column:
        return F.pmod(of, F.lit(buckets << 15)) + 1

    held = seen.select(place(F.col("digest")).alias("at")).repartition(F.bitmap_bucket_number("at").alias("b"))
    bits = held.groupBy(F.bitmap_bucket_number("at").alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits"))
    per, piece, held_bits = 4096 // PIECE, f"{name}_piece", f"{name}_bits"
    pieces = bits.select("b", "bits", F.explode(F.sequence(F.lit(0), F.lit(per - 1))).alias("k")).select(
        ((F.col("b") - 1) * per + F.col("k")).cast("long").alias(piece),
        F.expr(f"substring(bits, k * {PIECE} + 1, {PIECE})").alias(held_bits))
    spot = place(digest) - 1
    met = (df.withColumns({piece: F.floor(spot / F.lit(8 * PIECE)).cast("long"), f"{name}_at": F.pmod(spot, F.lit(8 * PIECE)).cast("int")})
           .join(F.broadcast(pieces), piece, "left"))
    byte = F.conv(F.hex(F.expr(f"substring(`{held_bits}`, `{name}_at` div 8 + 1, 1)")), 16, 10).cast("int")
    hit = F.coalesce(F.getbit(byte, F.pmod(f"{name}_at", F.lit(8))) == 1, F.lit(False))
    return met.select(*[F.col(f"`{c}`") for c in df.columns], hit.alias(name))


def _order_struct(order_by: list[str]) -> Column:
    return F.struct(*[F.col(c) for c in order_by])


def keep_one_per_key(df: DataFrame, key: str | list[str] = "surrogate_key", order_by: list[str] | None = None,
                     late: dict[str, Column] | None = None, keep: list[str] | None = None) -> DataFrame:
    """One row per key: the row with the smallest ``order_by`` tuple.

    The default order is ``payload_hash`` then every remaining column, which
    makes the survivor deterministic (unlike ``dropDuplicates``). ``late`` gives
    columns to add that are derived from the others: before the choice only where
    a key may occur again. ``keep`` names the columns to choose by and to return, if not all.
    """
    keys = [key] if isinstance(key, str) else list(key)
    late = late or {}
    marked = with_repeats(df, keys)
    kept = [*df.columns, *[c for c in late if c not in df.columns]] if keep is None else list(keep)

    def part(of: Column) -> DataFrame:
        return marked.where(of).withColumns(late).select(*[F.col(f"`{c}`") for c in kept])

    return part(~F.col("_again")).unionByName(_least_of_each(part(F.col("_again")), keys, order_by))


def _least_of_each(df: DataFrame, keys: list[str], order_by: list[str] | None) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    order = order_by or (["payload_hash"] if "payload_hash" in rest else [])
    tiebreak = [c for c in rest if c not in order]
    # The smallest struct is the row itself: one copy of it goes through the shuffle.
    survivor = F.min(_order_struct(order + tiebreak))
    return (df.groupBy(*keys)
              .agg(survivor.alias("_row"))
              .select(*keys, "_row.*")
              .select(*df.columns))


def duplicate_key_counts(df: DataFrame, key: str = "surrogate_key") -> DataFrame:
    """Keys that occur more than once, with the count (A11). Missing key counts as ``''``."""
    k = F.coalesce(F.col(key), F.lit(""))
    return (with_repeats(df.select(k.alias(key)), [key]).where("_again").groupBy(key)
              .agg(F.count(F.lit(1)).alias("occurrences"))
              .filter(F.col("occurrences") > 1))


def later_occurrences(df: DataFrame, key: str = "surrogate_key",
                      order_by: list[str] | None = None) -> DataFrame:
    """Second and later rows of each key (W3), without a per-key window.

    The input minus one survivor per key (``exceptAll`` keeps multiplicities):
    both sides are grouped with partial aggregation, so hot keys collapse early;
    rows whose key occurs once take no part. A missing key counts as ``''``.
    """
    keyed = with_repeats(df.withColumn("_k", F.coalesce(F.col(key), F.lit(""))), ["_k"]).where("_again").drop("_again")
    first = _least_of_each(keyed, ["_k"], order_by)
    return keyed.exceptAll(first).drop("_k")


def new_against_registry(lines: DataFrame, registry: DataFrame, stage: str, key: str = "surrogate_key",
                         late: dict[str, Column] | None = None, keep: list[str] | None = None) -> DataFrame:
    """Rows whose key is not yet registered for ``stage``.

    Input is first reduced to one row per key (so a hot key cannot skew the
    anti-join; ``late`` and ``keep`` as there), then anti-joined with the registry on (key, stage).
    """
    reg = registry.filter(F.col("stage") == F.lit(stage)).select(key)
    one = keep_one_per_key(lines, key, late=late, keep=keep)
    return one.join(reg, key, "left_anti")

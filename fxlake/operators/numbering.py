"""Dense 1-based numbering inside groups, without a per-group window.

``row_number() OVER (PARTITION BY g ORDER BY o)`` sends each group to one task;
with a handful of groups (24 source/geo pairs, or one batch) a single task
sorts a third of the data. Instead:

1. range-partition on ``(g, o)``: Spark samples the keys, so a large group is
   spread over many partitions of similar size;
2. inside each partition rows arrive sorted; ``monotonically_increasing_id`` is
   consecutive there, so ``id - min(id of the group in this partition)`` is the
   local rank;
3. a tiny table of per-(partition, group) counts (at most partitions + groups
   rows) gives each partition's offset by a running sum; it is broadcast back.

The order columns must make the order total (ties make the numbering arbitrary
between equal rows, as with ``row_number``). The range-partitioned frame is
written once to the checkpoint folder before it is used twice: range bounds come
from sampling the (shuffle-ordered) input, so two evaluations could disagree;
reading one written copy makes partition ids and ids consistent, and a lost
executor recomputes from the files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fxlake.operators.util import default_parallelism
from fxlake.session import stage_table


#: Rows a range partition holds on average, so that its sort fits a task's memory.
ROWS_A_PARTITION = 500_000


def range_partitions(spark: SparkSession, rows: int) -> int:
    """Partitions for a range partition of so many rows."""
    return max(default_parallelism(spark), int(spark.conf.get("spark.sql.shuffle.partitions", "8")), -(-rows // ROWS_A_PARTITION))


def by_range(df: DataFrame, order: list[str]) -> DataFrame:
    """``df`` in the order of its columns over partitions of about ``ROWS_A_PARTITION`` rows."""
    return df.repartitionByRange(range_partitions(df.sparkSession, df.count()), *order).sortWithinPartitions(*order)


def number_within(df: DataFrame, group: list[str], order: list[str | Column], out: str = "line_num",
                  partitions: int | None = None, keep: list[str] | None = None, expand: str | None = None) -> DataFrame:
    """``df`` with the number ``out``; ``keep`` names the columns to return besides ``group``, if not all.

    ``expand`` names an array of structs that a row stands for one row each of,
    with further columns (also of ``group``): rows are made of it after the shuffle.
    """
    spark = df.sparkSession
    n = partitions or range_partitions(spark, df.count() if expand is None else df.agg(F.sum(F.size(expand))).first()[0] or 0)
    ordered = [F.col(c) if isinstance(c, str) else c for c in order]
    keys = [*[F.col(c) for c in group], *ordered]
    rows = df.repartitionByRange(n, *[F.col(c) for c in group if c in df.columns], *ordered)
    if expand is not None:
        # Rows of a group are still spread by the order alone, so partitions follow each other in every group.
        rows = rows.select(*[F.col(f"`{c}`") for c in df.columns if c != expand], F.inline(expand))
    kept = rows.columns if keep is None else [c for c in rows.columns if c in {*group, *keep}]
    local = (rows.sortWithinPartitions(*keys)
               .select(*[F.col(f"`{c}`") for c in kept])
               .withColumn("_pid", F.spark_partition_id())
               .withColumn("_mono", F.monotonically_increasing_id()))
    local = stage_table(local, "numbering")
    stats = local.groupBy("_pid", *group).agg(F.count(F.lit(1)).alias("_cnt"),
                                               F.min("_mono").alias("_first"))
    w = Window.partitionBy(*group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stats.withColumn("_offset", F.coalesce(F.sum("_cnt").over(w), F.lit(0)))
    # At most (partitions + groups) rows: each partition holds a contiguous key range.
    numbered = local.join(F.broadcast(offsets.select("_pid", *group, "_first", "_offset")),
                          ["_pid", *group])
    return (numbered.withColumn(out, (F.col("_mono") - F.col("_first") + F.col("_offset") + 1).cast("int"))
                    .drop("_pid", "_mono", "_first", "_offset"))

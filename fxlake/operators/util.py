"""Scan helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame


def default_parallelism(spark) -> int:
    try:
        return int(spark.sparkContext.defaultParallelism)
    except Exception:  # noqa: BLE001 - e.g. a remote session without a SparkContext
        return int(spark.conf.get("spark.sql.shuffle.partitions", "8"))


def spread_scan(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin a scan that arrives in fewer splits than the cluster has cores.

    A fact table stored as one large row group is read by one task, and every
    narrow operator after it (joins against broadcast dimensions, projections,
    hashing) then runs on one core. On a large table the scan already has many
    splits and the frame is returned unchanged (no extra shuffle).
    """
    target = min_partitions or default_parallelism(df.sparkSession)
    if df.rdd.getNumPartitions() >= target:
        return df
    return df.repartition(target)

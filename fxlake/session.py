"""Session construction and lineage cutting.

Stages are cut by writing Parquet under the cluster's shared checkpoint folder
(``spark.checkpoint.dir``). The folder is read from the session; a local one is
only created when none is configured (tests, single-machine runs).
"""

from __future__ import annotations

import functools
import hashlib
import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "fxlake") -> SparkSession:
    """A session tuned for this workload. On a cluster, pass ``master=None``."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    cores = os.cpu_count() or 8
    builder = (
        builder
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or max(8, cores)))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master and master.startswith("local"):
        builder = builder.config("spark.driver.memory", os.environ.get("FXLAKE_DRIVER_MEMORY", "16g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


# Runtime SQL settings the plans rely on. Constraint propagation infers
# predicates over every aliased expression; over the wide canonical projection it
# grows exponentially (minutes of planning), and none of these plans needs it.
# Rows grow from narrow to wide within a stage (a line item becomes two to four
# lines of 24 columns), so splits and shuffle partitions are kept small: the sorts
# above them then fit a task's memory and do not spill.
RUNTIME_CONF = {
    "spark.sql.files.maxPartitionBytes": "16m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "400",
    "spark.sql.constraintPropagation.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply ``RUNTIME_CONF`` to an existing session (cheap, idempotent)."""
    for k, v in RUNTIME_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


# Codec of stage and lake tables: about half the bytes of the default one.
COMPRESSION = "zstd"


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for stage outputs. Only a local session may go without a setting: it gets one of its own."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not configured:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise RuntimeError(f"spark.checkpoint.dir is not set and the master is {master}: set it to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="fxlake-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(configured)
    return configured


def is_missing(exc: Exception) -> bool:
    """Whether a read failed because its path does not exist."""
    return "PATH_NOT_FOUND" in str(exc) or "does not exist" in str(exc)


def delete_path(spark: SparkSession, path: str) -> bool:
    """Remove a folder of a table, if it exists, through the file system that holds it."""
    fs, p = hadoop_path(spark, path)
    return bool(fs.exists(p) and fs.delete(p, True))


def drop_stages(spark: SparkSession) -> None:
    """Remove this application's stage tables, once nothing reads them any more."""
    delete_path(spark, _stage_root(spark))


def _stage_root(spark: SparkSession) -> str:
    return f"{checkpoint_dir(spark)}/stages/{spark.sparkContext.applicationId}"


#: Folders of the stage tables of this process, in order.
_STAGES: list[str] = []


def release(spark: SparkSession) -> None:
    """Lets Spark remove the shuffle files of jobs that are done.

    It does so once the driver has collected their plans as garbage, which a
    driver with room to spare puts off while the disks of the executors fill.
    """
    try:
        spark.sparkContext._jvm.java.lang.System.gc()
    except Exception:  # noqa: BLE001 - no JVM gateway (e.g. a remote session)
        pass


def drop_table(table: DataFrame) -> None:
    """Remove a stage table that nothing reads any more, and the shuffle files it was made of."""
    path = getattr(table, "_stage", None)
    if path in _STAGES:
        _STAGES.remove(path)
        delete_path(table.sparkSession, path)
    release(table.sparkSession)


def stage_table(df: DataFrame, label: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` once as Parquet in the checkpoint folder and read it back.

    This cuts the lineage (a lost executor recomputes from the files, not from
    the source scans) and gives later stages column pruning and filter pushdown
    on the stage output.
    """
    spark = df.sparkSession
    path = f"{_stage_root(spark)}/{label}-{uuid.uuid4().hex}"
    writer = df.write.mode("overwrite").option("compression", COMPRESSION)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    # Restore the column order of the input (partition columns move last).
    out = spark.read.parquet(path).select(*df.columns)
    _STAGES.append(path)
    out._stage = path
    return out


@functools.lru_cache(maxsize=1)
def _code_version() -> str:
    """Hash of the library source (once per process): a code change invalidates memoised tables."""
    root = os.path.dirname(os.path.abspath(__file__))
    h = hashlib.sha1()
    for dirpath, _, files in sorted(os.walk(root)):
        for f in sorted(files):
            if f.endswith(".py"):
                with open(os.path.join(dirpath, f), "rb") as fh:
                    h.update(f.encode() + fh.read())
    return h.hexdigest()


def hadoop_path(spark: SparkSession, path: str):
    """The file system of ``path``, and the path as it wants it."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def input_fingerprint(spark: SparkSession, *paths: str) -> str:
    """Fingerprint of input folders and all files below them (path, length, time) and of the code."""
    h = hashlib.sha1(_code_version().encode())
    try:
        for path in paths:
            fs, p = hadoop_path(spark, path)
            files = fs.listFiles(p, True)
            found = []
            while files.hasNext():
                st = files.next()
                found.append(f"{st.getPath().toString()}|{st.getLen()}|{st.getModificationTime()};")
            h.update("".join(sorted(found)).encode())
    except Exception:  # noqa: BLE001 - inputs cannot be listed: never reuse a table
        h.update(uuid.uuid4().hex.encode())
    return h.hexdigest()[:20]


def lake_table(spark: SparkSession, name: str, fingerprint: str, build) -> DataFrame:
    """A derived lake table (e.g. Silver) written once per input version and read thereafter.

    Downstream jobs read the table instead of recomputing it from the raw joins,
    as in a medallion lake. The table lives in the shared checkpoint folder; it
    counts as present only when its ``_SUCCESS`` marker exists, so a run that
    died half-way rebuilds it. Stage tables that ``build`` made are removed when it is written.
    """
    path = f"{checkpoint_dir(spark)}/tables/{name}-{fingerprint}"
    try:
        fs, marker = hadoop_path(spark, f"{path}/_SUCCESS")
        present = fs.exists(marker)
    except Exception:  # noqa: BLE001 - no JVM gateway (e.g. a remote session): cut lineage only
        return stage_table(build(), name)
    if not present:
        # Built aside, then published by one rename: of two sessions that build it, one wins and both read it whole.
        aside, begun = f"{path}-{uuid.uuid4().hex}", len(_STAGES)
        build().write.option("compression", COMPRESSION).parquet(aside)
        for stage in _STAGES[begun:]:
            delete_path(spark, stage)
        del _STAGES[begun:]
        release(spark)
        _, target = hadoop_path(spark, path)
        _, source = hadoop_path(spark, aside)
        if fs.exists(marker) or not fs.rename(source, target):
            fs.delete(source, True)
    return spark.read.parquet(path)

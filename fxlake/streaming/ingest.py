"""Intercompany event stream to Bronze.

Events are lines of base64 text, each holding one JSON object. ``run_stream``
takes any streaming DataFrame with a text column ``value`` (files here; a Kafka
source with its value cast to string elsewhere). The plan has two branches over
the same micro-batch:

* valid events go through the state store, which drops keys seen before
  (``dropDuplicates`` with RocksDB; with ``bound`` it is
  ``dropDuplicatesWithinWatermark``, whose state forgets keys older than that);
* all events pass without state, and only what tells a payload from a broken one
  is parsed. They are counted, undecodable payloads leave for the dead letters
  (T5), and events below the watermark, which the state store drops unseen, are
  parsed whole and looked up in the registry, so a bounded state loses nothing.

Each micro-batch is written once, and Bronze, registry, Silver, quarantine,
dead letters and counters of its run and epoch are derived from that. The
counters (A9) are part of the micro-batch: a crash before its commit repeats
it and overwrites them, so they never miss an epoch.

A run is the checkpoint's query id. Output of the same (run, epoch) is
overwritten, so a replayed micro-batch gives the same answer. A replaced
checkpoint is another run with an empty state: it overwrites nothing, and its
events and dead letters are anti-joined with those of earlier runs.
"""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from fxlake.functions.keys import payload_hash, surrogate_key
from fxlake.functions.scalar import date_prefix, period_name
from fxlake.operators.dedup import keep_one_per_key
from fxlake.operators.quality import quarantine_split
from fxlake.session import delete_path, is_missing
from fxlake.schema import AMOUNT_TYPE, CANONICAL_COLUMNS, CANONICAL_SCHEMA, DEFAULT_SPARE, RATE_TYPE, STREAM_SOURCE_SYSTEM

SEGMENT_FIELDS = T.StructType([T.StructField(n, T.StringType()) for n in
                               ["entity", "cost_center", "account", "project", "intercompany", "product", "spare"]])
_FLAT = ["journal_id", "journal_line_num", "ledger_line_num", "ledger_id", "effective_date", "currency_code",
         "entered_dr", "entered_cr", "accounted_dr", "accounted_cr", "fx_rate", "segment1_entity",
         "segment2_cost_center", "segment3_account", "segment4_project", "segment5_intercompany",
         "segment6_product", "segment7_spare", "description", "legal_entity"]
EVENT_SCHEMA = T.StructType(
    [T.StructField(n, T.StringType()) for n in _FLAT]
    + [T.StructField("account_segments", SEGMENT_FIELDS), T.StructField("_corrupt_record", T.StringType())])
# What tells whether a payload is broken (text fields take any value; the nested one takes objects only), and its date.
JUDGED_SCHEMA = T.StructType([f for f in EVENT_SCHEMA.fields if f.name in ("effective_date", "account_segments", "_corrupt_record")])

BRONZE_COLUMNS = [c for c in CANONICAL_COLUMNS if c != "load_timestamp"]
STAGE = "bronze"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def parse_events(raw: DataFrame, schema: T.StructType = EVENT_SCHEMA) -> DataFrame:
    """base64 text -> payload struct; adds ``is_corrupt``."""
    payload = F.decode(F.try_to_binary(F.col("value"), F.lit("base64")), "UTF-8")
    e = F.from_json("payload", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    # An array of one: a filter on ``e`` stays above it and does not parse the payload once more.
    parsed = raw.select(F.col("value").alias("raw_value"), payload.alias("payload")).select("*", F.explode(F.array(e)).alias("e"))
    corrupt = F.col("payload").isNull() | F.col("e").isNull() | F.col("e._corrupt_record").isNotNull()
    return parsed.withColumn("is_corrupt", corrupt)


def normalise(events: DataFrame, run_ts: dt.datetime, keep: list[str] | None = None) -> DataFrame:
    """Payload struct -> canonical row (P4, H3, H4, H16): flat field, then nested segment,
    then legacy name, then default."""
    e = lambda name: F.col(f"e.{name}")
    seg = lambda name: F.col(f"e.account_segments.{name}")
    eff = date_prefix(e("effective_date"))
    cols = {
        "source_system": F.lit(STREAM_SOURCE_SYSTEM),
        "journal_id": e("journal_id"),
        "journal_line_num": F.coalesce(e("journal_line_num"), e("ledger_line_num")).try_cast("int"),
        "ledger_id": e("ledger_id"),
        "effective_date": eff,
        "period_name": period_name(eff),
        "currency_code": e("currency_code"),
        "entered_dr": e("entered_dr").try_cast(AMOUNT_TYPE),
        "entered_cr": e("entered_cr").try_cast(AMOUNT_TYPE),
        "accounted_dr": e("accounted_dr").try_cast(AMOUNT_TYPE),
        "accounted_cr": e("accounted_cr").try_cast(AMOUNT_TYPE),
        "fx_rate": e("fx_rate").try_cast(RATE_TYPE),
        "segment1_entity": F.coalesce(e("segment1_entity"), seg("entity"), e("legal_entity")),
        "segment2_cost_center": F.coalesce(e("segment2_cost_center"), seg("cost_center")),
        "segment3_account": F.coalesce(e("segment3_account"), seg("account")),
        "segment4_project": F.coalesce(e("segment4_project"), seg("project")),
        "segment5_intercompany": F.coalesce(e("segment5_intercompany"), seg("intercompany")),
        "segment6_product": F.coalesce(e("segment6_product"), seg("product")),
        "segment7_spare": F.coalesce(e("segment7_spare"), seg("spare"), F.lit(DEFAULT_SPARE)),
        "description": F.coalesce(e("description"), F.lit("")),
        "batch_id": F.lit(f"ico-stream-{run_ts:%Y%m%d}"),
        "load_timestamp": F.lit(run_ts).cast("timestamp"),
    }
    out = events.select(*[v.alias(k) for k, v in cols.items()], *(keep or []))
    out = out.withColumns({"surrogate_key": surrogate_key(), "payload_hash": payload_hash()})
    return out.select(*CANONICAL_COLUMNS, *(keep or []))


#: The two branches of a micro-batch, and the event time of events that have none.
UNIQUE, SEEN = "unique", "seen"
EARLIEST = "1970-01-01 00:00:00"


def branches(stream: DataFrame, run_ts: dt.datetime, bound: str | None = None) -> DataFrame:
    """The plan before the sink: events of new keys (``kind`` unique) and every event without state (seen).

    ``bound`` (an interval such as ``30 days``) limits the state to keys whose
    event time lies that far below the latest one. The event time is the
    effective date, which the key holds too, so equal keys have equal times.
    """
    def timed(effective_date: Column) -> Column:
        return F.coalesce(effective_date.cast("timestamp"), F.lit(EARLIEST).cast("timestamp")).alias("event_time")

    good = normalise(parse_events(stream).where(~F.col("is_corrupt")), run_ts, keep=["is_corrupt"])
    good = good.select("*", timed(F.col("effective_date")))
    if bound is None:
        unique = good.dropDuplicates(["surrogate_key"])
    else:
        unique = good.withWatermark("event_time", bound).dropDuplicatesWithinWatermark(["surrogate_key"])
    # Only the counts, the dead letters and, as they came, the events below the watermark are needed of the others.
    held = F.col("raw_value") if bound is not None else F.when(F.col("is_corrupt"), F.col("raw_value"))
    seen = parse_events(stream, JUDGED_SCHEMA).select(
        *[F.lit(None).cast(good.schema[c].dataType).alias(c) for c in CANONICAL_COLUMNS], "is_corrupt", timed(date_prefix(F.col("e.effective_date"))),
        held.alias("raw_value"))
    unique = unique.withColumn("raw_value", F.lit(None).cast("string"))
    return unique.withColumn("kind", F.lit(UNIQUE)).unionByName(seen.withColumn("kind", F.lit(SEEN)))


def _read(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as exc:
        if not is_missing(exc):
            raise
        return None


def _watermark(spark: SparkSession, root: str, run: str, epoch_id: int, bound: str) -> dt.datetime:
    """A time that the stream's watermark does not pass in this epoch: the latest event of earlier ones less ``bound``."""
    counters = _read(spark, f"{root}/counters")
    earliest = F.lit(EARLIEST).cast("timestamp")
    if counters is None:
        return spark.range(1).select(earliest).first()[0]
    before = counters.where((F.col("run") == run) & (F.col("epoch") < epoch_id))
    return before.agg(F.greatest(earliest, F.max("latest") - F.expr(f"INTERVAL {bound}"))).first()[0]


def process_batch(spark: SparkSession, batch: DataFrame, run: str, epoch_id: int, root: str, run_ts: dt.datetime,
                  bound: str | None = None) -> None:
    """One micro-batch of ``branches``: write it once, then derive every output of (run, epoch) from that."""
    part = f"run={run}/epoch={epoch_id}"

    def write(df: DataFrame, table: str) -> str:
        path = f"{root}/{table}/{part}"
        df.write.mode("overwrite").parquet(path)
        return path

    def others(table: str) -> DataFrame | None:
        """What other runs hold of ``table``."""
        rows = _read(spark, f"{root}/{table}")
        if rows is None or (rows := rows.where(F.col("run") != run)).isEmpty():
            return None
        return rows

    seen = F.col("kind") == SEEN
    needed = ~seen | F.col("is_corrupt")
    if bound is not None:
        needed = needed | (F.col("event_time") <= F.lit(_watermark(spark, root, run, epoch_id, bound)))
    counted = Observation()
    rows = batch.observe(counted, F.count_if(seen).alias("rows"), F.count_if(seen & F.col("is_corrupt")).alias("corrupt"),
                         F.max(F.when(seen & ~F.col("is_corrupt"), F.col("event_time"))).alias("latest"))
    staged = write(rows.where(needed), "_staged")
    rows = spark.read.parquet(staged)
    seen_before, letters_before = others("registry"), others("corrupt")

    letters = rows.where(seen & F.col("is_corrupt")).select("raw_value")
    if letters_before is not None:
        letters = letters.join(letters_before.select("raw_value"), "raw_value", "left_anti")
    write(letters, "corrupt")

    fresh = rows.where(~seen).select(*CANONICAL_COLUMNS)
    if bound is not None:
        fresh = fresh.unionByName(_late(spark, rows, fresh, run, epoch_id, root, run_ts))
    if seen_before is not None:
        fresh = fresh.join(seen_before.select("surrogate_key"), "surrogate_key", "left_anti").select(*CANONICAL_COLUMNS)
    bronze = write(fresh, "bronze")
    landed = spark.read.schema(CANONICAL_SCHEMA).parquet(bronze)
    write(landed.select("surrogate_key", F.lit(STREAM_SOURCE_SYSTEM).alias("source_system"), F.lit(STAGE).alias("stage"),
                        F.lit(bronze).alias("object_key"), "payload_hash",
                        F.lit(run_ts).cast("timestamp").alias("processed_at")), "registry")
    # The accepted events continue to Silver in the same micro-batch (P6 split).
    valid, bad = quarantine_split(landed)
    write(valid, "silver")
    write(bad, "quarantine")
    counts = counted.get
    totals = spark.createDataFrame([(counts["rows"], counts["corrupt"], counts["latest"])], "rows long, corrupt long, latest timestamp")
    write(totals.coalesce(1).withColumn("accepted", F.lit(landed.count())), "counters")
    delete_path(spark, staged)


def _late(spark: SparkSession, rows: DataFrame, unique: DataFrame, run: str, epoch_id: int, root: str, run_ts: dt.datetime) -> DataFrame:
    """Events below the watermark that neither this micro-batch's state nor an earlier epoch of the run has let through."""
    late = rows.where((F.col("kind") == SEEN) & ~F.col("is_corrupt")).select(F.col("raw_value").alias("value"))
    late = normalise(parse_events(late), run_ts)
    late = keep_one_per_key(late, "surrogate_key").join(unique.select("surrogate_key"), "surrogate_key", "left_anti")
    registry = _read(spark, f"{root}/registry")
    if registry is not None:
        before = registry.where((F.col("run") == run) & (F.col("epoch") < epoch_id)).select("surrogate_key")
        late = late.join(before, "surrogate_key", "left_anti")
    return late.select(*CANONICAL_COLUMNS)


def run_stream(stream: DataFrame, root: str, run_ts: dt.datetime, checkpoint: str | None = None, bound: str | None = None,
               after_epoch=None) -> StreamingQuery:
    """Process what any streaming source (a text column ``value``) holds now, then stop (Trigger.AvailableNow, T1).

    ``bound`` limits the state (see ``branches``); a checkpoint keeps the one it
    began with. ``after_epoch(epoch)`` is called when a micro-batch has written
    its outputs and is not committed yet. Returns the ended query.
    """
    spark = stream.sparkSession
    checkpoint = checkpoint or f"{root}/_checkpoint"

    def handle(batch: DataFrame, epoch: int) -> None:
        process_batch(spark, batch, _run_id(spark, checkpoint), epoch, root, run_ts, bound)
        if after_epoch is not None:
            after_epoch(epoch)

    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    spark.conf.set(key, ROCKSDB)
    try:
        query = (branches(stream, run_ts, bound).writeStream.foreachBatch(handle)
                 .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    finally:
        spark.conf.set(key, before) if before is not None else spark.conf.unset(key)
    query.awaitTermination()
    return query


def _run_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that the checkpoint gives its query, the same after every restart."""
    return spark.read.schema("id string").json(f"{checkpoint}/metadata").first().id


def run_available(spark: SparkSession, input_dir: str, root: str, run_ts: dt.datetime,
                  max_files_per_trigger: int = 1000, checkpoint: str | None = None, bound: str | None = None, after_epoch=None) -> StreamingQuery:
    """``run_stream`` over the text files of a folder that the checkpoint has not seen."""
    stream = (spark.readStream.format("text")
              .option("maxFilesPerTrigger", max_files_per_trigger)
              .option("pathGlobFilter", "*.txt")
              .load(input_dir))
    return run_stream(stream, root, run_ts, checkpoint, bound, after_epoch)


def read_bronze(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/bronze")


def read_silver(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/silver")


def read_corrupt(spark: SparkSession, root: str) -> DataFrame:
    """Dead letters: payloads that could not be decoded, as they came (T5)."""
    return spark.read.parquet(f"{root}/corrupt")


def read_counters(spark: SparkSession, root: str) -> DataFrame:
    """Per (run, epoch) with input: events accepted, skipped as repeats, and corrupt (A9). Few rows: one a micro-batch."""
    return spark.read.parquet(f"{root}/counters").where("rows > 0").select(
        F.col("run").cast("string").alias("run"), F.col("epoch").cast("long").alias("epoch"), "accepted",
        (F.col("rows") - F.col("corrupt") - F.col("accepted")).alias("skipped"), "corrupt")

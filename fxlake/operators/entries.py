"""Journal-entry generation per ledger source and geo.

Input lines carry ``ledger_source`` and an optional ``geo_tag``. For each
(period batch, source, geo):

* a line matches when its geo tag equals the geo or is absent;
* a (batch, source, geo) without any match takes every line of that source in
  the batch (fallback);
* matched and fallback lines are numbered 1..n per (batch, source, geo) and
  projected to the 24 columns with entry defaults, keyed and hashed.

All periods of the input are generated in one job: every line belongs to the
period (1, 3 or 12 calendar months) that contains its date, and the entry
carries that period's last day as its effective date.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fxlake.functions.keys import payload_hash, surrogate_key
from fxlake.functions.scalar import period_name
from fxlake.operators.numbering import number_within
from fxlake.session import stage_table
from fxlake.schema import (
    AMOUNT_TYPE,
    CANONICAL_COLUMNS,
    DEFAULT_SPARE,
    ENTRY_DEFAULT_ACCOUNT,
    ENTRY_DEFAULT_COST_CENTER,
    ENTRY_DEFAULT_CURRENCY,
    ENTRY_DEFAULT_FX_RATE,
    ENTRY_DEFAULT_INTERCOMPANY,
    ENTRY_DEFAULT_PRODUCT,
    ENTRY_DEFAULT_PROJECT,
    KEY_COLUMNS,
    LEDGER_SOURCES,
    PERIOD_MONTHS,
    PRIMARY_LEDGER_SUFFIX,
    RATE_TYPE,
    SEGMENT_COLUMNS,
    SUPPORTED_GEOS,
)

# Columns of a line that its entry takes over.
LINE_FIELDS = [
    "journal_id", "ledger_id", "currency_code", "entered_dr", "entered_cr", "accounted_dr", "accounted_cr", "fx_rate",
    *SEGMENT_COLUMNS, "description",
]

ENTRY_COLUMNS = [*CANONICAL_COLUMNS, "geo", "ledger_source", "period_type"]
DEFAULT_RUN_TS = dt.datetime(2024, 1, 1)


def months_of(period_type: str) -> int:
    """Months per period; an unknown period type books monthly windows."""
    return PERIOD_MONTHS.get(period_type, 1)


def period_end(date_col: str | Column, months: int) -> Column:
    """Last day of the calendar block of ``months`` months containing the date."""
    d = F.col(date_col) if isinstance(date_col, str) else date_col
    start = F.add_months(F.trunc(d, "MM"), -((F.month(d) - 1) % months))
    return F.last_day(F.add_months(start, months - 1))


def in_period_window(date_col: str | Column, period_type: str, effective_date: str) -> Column:
    """True when the date lies in the 1/3/12 months ending at ``effective_date``."""
    d = F.col(date_col) if isinstance(date_col, str) else date_col
    end = F.lit(effective_date).cast("date")
    start = F.add_months(F.trunc(end, "MM"), -(months_of(period_type) - 1))
    return (d >= start) & (d <= F.last_day(end))


def batch_id_for(period_type: str, end: Column) -> Column:
    """``je-<period>-<yyyy-MM-dd>``: deterministic, so a rerun targets the same batch."""
    return F.concat(F.lit(f"je-{period_type.lower()}-"), end.cast("string"))


TARGETS = "_targets"


def with_targets(lines: DataFrame, geos: list[str], sources: list[str]) -> DataFrame:
    """Lines with the geos they go to per (batch, source) (J5): an array ``TARGETS`` of (``geo``, ``is_fallback``).

    Matches, then fallback for geos without any. No cross join: a line with no
    geo tag goes to the (parameter) geo list; fallback geos are a table of at
    most batches x sources rows, whose size Spark knows.
    """
    geo_arr = F.array(*[F.lit(g) for g in geos])
    # A line's own geo is its tag; the assigned geo replaces any ``geo`` column.
    src = lines.drop("geo").filter(F.col("ledger_source").isin(sources))

    def target(geo: Column, fallback: bool) -> Column:
        return F.struct(geo.alias("geo"), F.lit(fallback).alias("is_fallback"))

    # Cases of whole arrays, not a lambda over each line's, which Spark would interpret.
    kind = "array<struct<geo:string,is_fallback:boolean>>"
    own = (F.when(F.col("geo_tag").isNull(), F.array(*[target(F.lit(g), False) for g in geos]).cast(kind))
            .when(F.col("geo_tag").isin(geos), F.array(target(F.col("geo_tag"), False)).cast(kind)).otherwise(F.array().cast(kind)))
    # Geos covered per (batch, source): all when any line is untagged, else the tags seen.
    cover = (src.groupBy("batch_id", "ledger_source", "geo_tag").agg(F.count(F.lit(1)).alias("_n"))
                .groupBy("batch_id", "ledger_source")
                .agg(F.max(F.col("geo_tag").isNull().cast("int")).alias("_any_untagged"),
                     F.collect_set(F.when(F.col("geo_tag").isin(geos), F.col("geo_tag"))).alias("_tags")))
    absent = F.array_except(geo_arr, F.col("_tags"))
    missing = (cover.where("_any_untagged = 0").where(F.size(absent) > 0)
                    .select("batch_id", "ledger_source", F.transform(absent, lambda g: target(g, True)).cast(kind).alias("_missing")))
    # Written once (at most batches x sources rows): the join reads the small
    # table, of known size, instead of re-aggregating every line.
    missing = stage_table(missing, "fanout-pairs")
    targets = F.when(F.col("_missing").isNull(), own).otherwise(F.concat(own, "_missing"))
    return src.join(missing, ["batch_id", "ledger_source"], "left").withColumn(TARGETS, targets).drop("_missing").select(
        *src.columns, TARGETS)


def fan_out(lines: DataFrame, geos: list[str], sources: list[str]) -> DataFrame:
    """Lines assigned to geos (J5), a row for each target of ``with_targets``. Adds ``geo`` and ``is_fallback``."""
    out = with_targets(lines, geos, sources)
    return out.select(*[F.col(f"`{c}`") for c in out.columns if c != TARGETS], F.inline(TARGETS))


def build_entries(assigned: DataFrame, period_type: str, run_ts: dt.datetime = DEFAULT_RUN_TS) -> DataFrame:
    """Number lines per (batch, source, geo) (W1) and project to entries with defaults (P5).

    ``assigned`` carries ``batch_id``, ``period_end``, ``ledger_source``, ``geo``
    and the sub-ledger fields (any may be null: defaults apply). With the array
    ``TARGETS`` instead of ``geo`` a line is shuffled once, not once a geo.
    """
    order: list[str | Column] = [c for c in ["journal_id", "journal_line_num"] if c in assigned.columns]
    # Only what an entry is made of travels; the key of the line is needed for the order alone.
    used = [c for c in [*LINE_FIELDS, "period_end"] if c in assigned.columns]
    group = ["batch_id", "ledger_source", "geo"]
    expand = TARGETS if TARGETS in assigned.columns else None
    travel = [*[c for c in group if c in assigned.columns], *order, *used, *([expand] if expand else ["is_fallback"])]
    if "surrogate_key" in assigned.columns:
        if set(KEY_COLUMNS) <= set(assigned.columns):
            # Like the digests of the sinks, a key that the columns give does not travel but is derived again.
            foreign = ~F.col("surrogate_key").eqNullSafe(surrogate_key())
            assigned = assigned.withColumns({"_foreign": foreign, "_own": F.when(foreign, F.col("surrogate_key"))})
            travel += [*KEY_COLUMNS, "_foreign", "_own"]
            order.append(F.when(F.col("_foreign"), F.col("_own")).otherwise(surrogate_key()))
        else:
            travel.append("surrogate_key")
            order.append("surrogate_key")
    numbered = number_within(assigned.select(*dict.fromkeys(travel)), group, order, out="_line", keep=[*used, "is_fallback"], expand=expand)
    has = set(numbered.columns)

    def opt(name: str, dtype: str = "string"):
        """The sub-ledger field, or a typed null when the input has no such column."""
        return F.col(name) if name in has else F.lit(None).cast(dtype)

    geo = F.col("geo")
    source = F.col("ledger_source")
    entered_dr = F.coalesce(opt("entered_dr", "decimal(20,4)"), F.lit(0).cast(AMOUNT_TYPE))
    entered_cr = F.coalesce(opt("entered_cr", "decimal(20,4)"), F.lit(0).cast(AMOUNT_TYPE))
    cols = {
        "source_system": F.concat(source, F.lit("_FX")),
        "journal_id": F.coalesce(opt("journal_id", "string"), F.concat_ws(
            "-", source, geo, F.substring(F.md5(F.concat_ws("|", source, geo, F.col("batch_id"))), 1, 8))),
        "journal_line_num": F.col("_line"),
        "ledger_id": F.coalesce(opt("ledger_id", "string"), F.concat(geo, F.lit(PRIMARY_LEDGER_SUFFIX))),
        "effective_date": F.col("period_end"),
        "period_name": period_name(F.col("period_end")),
        "currency_code": F.coalesce(opt("currency_code", "string"), F.lit(ENTRY_DEFAULT_CURRENCY)),
        "entered_dr": entered_dr,
        "entered_cr": entered_cr,
        "accounted_dr": F.coalesce(opt("accounted_dr", "decimal(20,4)"), entered_dr),
        "accounted_cr": F.coalesce(opt("accounted_cr", "decimal(20,4)"), entered_cr),
        "fx_rate": F.coalesce(opt("fx_rate", "decimal(18,8)"), F.lit(ENTRY_DEFAULT_FX_RATE).cast(RATE_TYPE)),
        "segment1_entity": F.coalesce(opt("segment1_entity", "string"), geo),
        "segment2_cost_center": F.coalesce(opt("segment2_cost_center", "string"), F.lit(ENTRY_DEFAULT_COST_CENTER)),
        "segment3_account": F.coalesce(opt("segment3_account", "string"), F.lit(ENTRY_DEFAULT_ACCOUNT)),
        "segment4_project": F.coalesce(opt("segment4_project", "string"), F.lit(ENTRY_DEFAULT_PROJECT)),
        "segment5_intercompany": F.coalesce(opt("segment5_intercompany", "string"), F.lit(ENTRY_DEFAULT_INTERCOMPANY)),
        "segment6_product": F.coalesce(opt("segment6_product", "string"), F.lit(ENTRY_DEFAULT_PRODUCT)),
        "segment7_spare": F.coalesce(opt("segment7_spare", "string"), F.lit(DEFAULT_SPARE)),
        "description": F.coalesce(opt("description", "string"),
                                  F.concat(source, F.lit(" FX adjustment — "), geo)),
        "batch_id": F.col("batch_id"),
        "load_timestamp": F.lit(run_ts).cast("timestamp"),
        "geo": geo,
        "ledger_source": source,
        "period_type": F.lit(period_type),
    }
    projected = numbered.select(*[v.alias(k) for k, v in cols.items()], "is_fallback")
    keyed = projected.withColumns({"surrogate_key": surrogate_key(), "payload_hash": payload_hash()})
    return keyed.select(*ENTRY_COLUMNS, "is_fallback")


def generate(lines: DataFrame, period_type: str = "MONTHLY", geos: list[str] | None = None,
             sources: list[str] | None = None, effective_date: str | None = None,
             run_ts: dt.datetime = DEFAULT_RUN_TS) -> DataFrame:
    """Entries for every period of ``lines`` (F4), or for the one period ending at ``effective_date``."""
    geos = geos or SUPPORTED_GEOS
    sources = sources or LEDGER_SOURCES
    months = months_of(period_type)
    src = lines
    if effective_date is not None:
        src = src.filter(in_period_window("effective_date", period_type, effective_date))
        end = F.last_day(F.lit(effective_date).cast("date"))
    else:
        end = period_end("effective_date", months)
    src = src.withColumn("period_end", end).withColumn("batch_id", batch_id_for(period_type, F.col("period_end")))
    return build_entries(with_targets(src, geos, sources), period_type, run_ts)

"""Projection of raw inputs onto the 24-column contract."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fxlake.functions.keys import payload_hash, surrogate_key
from fxlake.functions.scalar import date_prefix, is_lost_amount, period_name
from fxlake.schema import (
    AMOUNT_COLUMNS,
    AMOUNT_TYPE,
    BATCH_SOURCE_SYSTEM,
    CANONICAL_COLUMNS,
    CANONICAL_TYPES,
    DEFAULT_SPARE,
    RATE_TYPE,
    SEGMENT_COLUMNS,
)

# Source columns that must exist in a batch file (an error otherwise).
REQUIRED_SOURCE_COLUMNS = ["journal_id", "ledger_id", "currency_code"]

# Alternative source names, tried in order.
COLUMN_ALIASES = {
    "journal_line_num": ["journal_line_num", "line_num"],
    "effective_date": ["effective_date", "acct_date"],
}

# Amount columns whose text is lost in the contract's type (optional column of ``canonicalize``).
AMOUNT_ERRORS = "amount_errors"

DEFAULT_RUN_TS = dt.datetime(2024, 1, 1)


def column_or_default(df: DataFrame, names: list[str] | str, default=None, dtype=None) -> Column:
    """First existing column of ``names`` (coalesced in order), else a typed literal."""
    names = [names] if isinstance(names, str) else names
    present = [F.col(n) for n in names if n in df.columns]
    if not present:
        col = F.lit(default)
    elif len(present) == 1:
        col = present[0]
    else:
        col = F.coalesce(*present)
    if default is not None and present:
        col = F.coalesce(col.cast("string") if dtype is not None else col, F.lit(default))
    return col.try_cast(dtype) if dtype is not None else col


def with_keys(df: DataFrame) -> DataFrame:
    """Add ``surrogate_key`` and ``payload_hash`` (H1, H2)."""
    return df.withColumns({"surrogate_key": surrogate_key(), "payload_hash": payload_hash()})


def canonicalize(raw: DataFrame, source_system: str | Column = BATCH_SOURCE_SYSTEM,
                 batch_id: str | Column | None = None, run_ts: dt.datetime = DEFAULT_RUN_TS,
                 keep: list[str] | None = None, amount_errors: bool = False) -> DataFrame:
    """Map a raw batch source (all text or typed) to the canonical 24 columns.

    * required identifiers must exist as columns;
    * aliases: ``line_num`` for ``journal_line_num``, ``acct_date`` for ``effective_date``;
    * every cast is a ``try_cast``: unparseable mandatory values become null and are quarantined.
      Amounts may be null, so with ``amount_errors`` a column of that name lists those whose
      text was given but does not parse or fit, and ``quarantine_split`` takes them out too;
    * ``segment7_spare`` defaults to ``000`` and ``description`` to ``''``;
    * ``batch_id`` is a parameter (literal or column), ``load_timestamp`` the run time.
    """
    missing = [c for c in REQUIRED_SOURCE_COLUMNS if c not in raw.columns]
    if missing:
        raise ValueError(f"batch source lacks required columns: {missing}")
    if batch_id is None:
        if "batch_id" not in raw.columns:
            raise ValueError("batch_id must be given as a parameter or a source column")
        batch_col = F.col("batch_id").cast("string")
    else:
        batch_col = F.lit(batch_id) if isinstance(batch_id, str) else batch_id
    source_col = F.lit(source_system) if isinstance(source_system, str) else source_system

    eff = column_or_default(raw, COLUMN_ALIASES["effective_date"]).cast("string")
    eff_date = F.coalesce(eff.try_cast("date"), date_prefix(eff))
    cols: dict[str, Column] = {
        "source_system": source_col,
        "journal_id": F.col("journal_id").cast("string"),
        "journal_line_num": column_or_default(raw, COLUMN_ALIASES["journal_line_num"]).cast("string").try_cast("int"),
        "ledger_id": F.col("ledger_id").cast("string"),
        "effective_date": eff_date,
        "currency_code": F.col("currency_code").cast("string"),
    }
    for c in AMOUNT_COLUMNS:
        cols[c] = column_or_default(raw, c, dtype=AMOUNT_TYPE)
    cols["fx_rate"] = column_or_default(raw, "fx_rate", dtype=RATE_TYPE)
    for c in SEGMENT_COLUMNS[:-1]:
        cols[c] = column_or_default(raw, c).cast("string")
    cols["segment7_spare"] = column_or_default(raw, "segment7_spare", DEFAULT_SPARE).cast("string")
    cols["description"] = column_or_default(raw, "description", "").cast("string")
    cols["batch_id"] = batch_col
    cols["load_timestamp"] = F.lit(run_ts).cast("timestamp")

    keep = list(keep or [])
    extra = [F.col(k) for k in keep]
    if amount_errors:
        bad = [F.when(is_lost_amount(c), F.lit(c)) for c in AMOUNT_COLUMNS if c in raw.columns]
        extra.append(F.concat_ws(",", *bad).alias(AMOUNT_ERRORS))
        keep.append(AMOUNT_ERRORS)
    projected = raw.select(*[v.alias(k) for k, v in cols.items()], *extra)
    projected = projected.withColumn("period_name", period_name("effective_date"))
    keyed = with_keys(projected)
    return keyed.select(*CANONICAL_COLUMNS, *keep)


def complete_schema(df: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """Add missing canonical columns as typed nulls and select them in order."""
    cols = []
    for c in CANONICAL_COLUMNS:
        if c in df.columns:
            cols.append(F.col(c))
        else:
            cols.append(F.lit(None).cast(CANONICAL_TYPES[c]).alias(c))
    return df.select(*cols, *[F.col(c) for c in (extra or [])])


def gold_batch(silver: DataFrame, batch_id: str, run_ts: dt.datetime = DEFAULT_RUN_TS) -> DataFrame:
    """One batch of Silver, completed to the 24 columns, with a Gold lineage time.

    The filter on the partition column prunes the Silver scan to one directory.
    """
    one = silver.filter(F.col("batch_id") == F.lit(batch_id))
    return complete_schema(one).withColumn("gold_timestamp", F.lit(run_ts).cast("timestamp"))

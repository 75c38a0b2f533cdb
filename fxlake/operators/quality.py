"""Quarantine split (P6 / O4) and the completeness gate helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fxlake.operators.canonical import AMOUNT_ERRORS
from fxlake.schema import NON_NULLABLE_COLUMNS


def null_reasons(columns: list[str] | None = None) -> Column:
    """Comma-separated names of the mandatory columns that are null ('' if none).

    ``concat_ws`` skips nulls, so no higher-order function is needed and the
    expression stays inside whole-stage codegen.
    """
    cols = NON_NULLABLE_COLUMNS if columns is None else columns
    return F.concat_ws(",", *[F.when(F.col(c).isNull(), F.lit(c)) for c in cols])


def all_present(columns: list[str] | None = None) -> Column:
    cols = NON_NULLABLE_COLUMNS if columns is None else columns
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return cond


def quarantine_split(df: DataFrame, columns: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(valid rows, quarantined rows with a comma-separated ``quarantine_reason``).

    A column ``amount_errors`` (see ``canonicalize``) counts too: its names end
    up in the reasons and the column itself leaves both results.
    """
    reason, good = null_reasons(columns), all_present(columns)
    if AMOUNT_ERRORS in df.columns:
        reason = F.concat_ws(",", F.nullif(reason, F.lit("")), F.nullif(F.col(AMOUNT_ERRORS), F.lit("")))
        good = good & (F.col(AMOUNT_ERRORS) == "")
    valid = df.filter(good).drop(AMOUNT_ERRORS)
    invalid = df.filter(~good).withColumn("quarantine_reason", reason).drop(AMOUNT_ERRORS)
    return valid, invalid

"""Scalar Column helpers. All are built-in Spark expressions (no UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fxlake.schema import AMOUNT_TYPE, WIDE_AMOUNT_TYPE


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def period_name(date_col: str | Column) -> Column:
    """``JAN-2024`` from a date; null stays null."""
    return F.upper(F.date_format(_c(date_col), "MMM-yyyy"))


def date_prefix(text_col: str | Column) -> Column:
    """Date from the first 10 characters (``yyyy-MM-dd``); unparseable gives null."""
    return F.try_to_date(F.substring(_c(text_col).cast("string"), 1, 10), "yyyy-MM-dd")


def safe_amount(c: str | Column) -> Column:
    """An amount to sum: null, blank, ``'null'`` and unparseable text count as zero.

    The type holds 28 digits before the point and 10 after it, so no amount of
    the contract or of a raw file is rounded or lost in a check.
    """
    return F.coalesce(_c(c).try_cast(WIDE_AMOUNT_TYPE), F.lit(0).cast(WIDE_AMOUNT_TYPE))


def is_lost_amount(c: str | Column) -> Column:
    """True for text that is there but that the contract's type cannot hold as it stands: no number, too large, or too fine."""
    text = F.trim(_c(c).cast("string"))
    kept, exact = text.try_cast(AMOUNT_TYPE), text.try_cast(WIDE_AMOUNT_TYPE)
    given = text.isNotNull() & ~F.lower(text).isin("", "null")
    return given & (kept.isNull() | exact.isNull() | (kept != exact))


def is_blank(c: str | Column) -> Column:
    """True when the value is null or only whitespace."""
    col = _c(c)
    return col.isNull() | (F.trim(col.cast("string")) == F.lit(""))


def file_stem(path_col: str | Column) -> Column:
    """Last path part with ``.json`` / ``.csv`` removed."""
    last = F.element_at(F.split(_c(path_col), "/"), -1)
    return F.replace(F.replace(last, F.lit(".json"), F.lit("")), F.lit(".csv"), F.lit(""))


def decode_object_key(c: str | Column) -> Column:
    """URL-decode an object key (``+`` is a space)."""
    return F.url_decode(_c(c))


def stable_id(prefix: str, *parts: str | Column, length: int = 8) -> Column:
    """Deterministic identifier ``<prefix><md5 prefix of parts>`` so reruns are idempotent."""
    digest = F.md5(F.concat_ws("|", *[_c(p).cast("string") for p in parts]))
    return F.concat(F.lit(prefix), F.substring(digest, 1, length))


def booking_reference(batch_id: str | Column, period_type: str | Column | None = None) -> Column:
    """``OFA-<period3>-<batch8>-<HEX6>``; without a period, ``OFA-<batch8>-<HEX6>``.

    The six hex characters are derived from the batch (not random) so a rerun
    produces the same reference.
    """
    batch = _c(batch_id)
    suffix = F.upper(F.substring(F.md5(batch), 1, 6))
    parts = [F.lit("OFA")]
    if period_type is not None:
        parts.append(F.substring(_c(period_type), 1, 3))
    parts += [F.substring(batch, 1, 8), suffix]
    return F.concat_ws("-", *parts)

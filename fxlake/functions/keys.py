"""Surrogate key and payload hash (Column builders)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fxlake.schema import KEY_SEPARATOR, PAYLOAD_COLUMNS


def _text(c: str | Column, default: str) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.coalesce(col.cast("string"), F.lit(default))


def surrogate_key(source_system: str | Column = "source_system",
                  journal_id: str | Column = "journal_id",
                  journal_line_num: str | Column = "journal_line_num",
                  effective_date: str | Column = "effective_date",
                  entered_dr: str | Column = "entered_dr") -> Column:
    """MD5 hex of source, journal, line, date and debit joined by ``||``.

    A null debit contributes ``"0"``; any other null contributes ``""``.
    Amounts enter as their ``decimal(20,4)`` text.
    """
    return F.md5(F.concat_ws(
        KEY_SEPARATOR,
        _text(source_system, ""),
        _text(journal_id, ""),
        _text(journal_line_num, ""),
        _text(effective_date, ""),
        _text(entered_dr, "0"),
    ))


def payload_hash(columns: list[str] | None = None) -> Column:
    """SHA-256 hex of the 20 payload columns joined by ``||``, null as ``""``."""
    cols = PAYLOAD_COLUMNS if columns is None else columns
    digest = F.sha2(F.concat_ws(KEY_SEPARATOR, *[_text(c, "") for c in cols]), 256)
    # sha2 is declared nullable (for invalid bit lengths) although 256 over a
    # non-null text never is; saying so lets Catalyst drop not-null checks instead
    # of computing the digest a second time inside a pushed-down filter.
    return F.coalesce(digest, F.lit(""))


def business_payload_hash() -> Column:
    """Payload hash without ``batch_id``: equal business rows hash equally across batches."""
    return payload_hash([c for c in PAYLOAD_COLUMNS if c != "batch_id"])

"""Shared stage builders over the fixture: canonical lines, Silver, Gold."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fxlake.functions.keys import payload_hash
from fxlake.operators.canonical import canonicalize, with_keys
from fxlake.operators.dedup import keep_one_per_key
from fxlake.operators.quality import quarantine_split
from fxlake.schema import CANONICAL_COLUMNS
from fxlake.session import input_fingerprint, lake_table
from fxlake.sources.fixture import FIXTURE_EXTRA, raw_journal_lines, source_system_of_ledger

# Survivor order of de-duplication on the fixture: smallest payload hash, then first delivery.
DEDUP_ORDER = ["payload_hash", "delivery"]


def canonical_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw fixture lines projected to the contract, keyed and hashed."""
    raw = raw_journal_lines(spark, sf_dir)
    return canonicalize(raw, source_system=source_system_of_ledger(), batch_id=None,
                        keep=FIXTURE_EXTRA)


def valid_and_quarantined(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return quarantine_split(canonical_lines(spark, sf_dir))


def keyed_table(spark: SparkSession, name: str, sf_dir: str, build) -> DataFrame:
    """A lake table of keyed lines. The key and the hash are functions of the other
    columns and do not compress, so they are not stored but derived when read."""
    def bare() -> DataFrame:
        return build().drop("surrogate_key", "payload_hash")

    table = lake_table(spark, name, input_fingerprint(spark, sf_dir), bare)
    return with_keys(table)


def valid_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid lines of every delivery (P6), as a lake table."""
    return keyed_table(spark, "valid-lines", sf_dir, lambda: valid_and_quarantined(spark, sf_dir)[0])


def silver_lines(spark: SparkSession, sf_dir: str, staged: bool = True) -> DataFrame:
    """Valid lines, one per surrogate key (P6, W6): the Silver table.

    ``staged`` reads the Silver lake table, built once per input version in the
    checkpoint folder (as the batch flow writes it), so later stages that read
    it several times neither recompute the joins nor re-plan the whole lineage.
    """
    def build() -> DataFrame:
        valid, _ = valid_and_quarantined(spark, sf_dir)
        # The hash is what the line's columns give: only lines of repeated keys need it to be chosen by.
        return keep_one_per_key(valid.drop("payload_hash"), "surrogate_key", DEDUP_ORDER, {"payload_hash": payload_hash()}).select(*valid.columns)

    if not staged:
        return build()
    return keyed_table(spark, "silver", sf_dir, build).select(*CANONICAL_COLUMNS, *FIXTURE_EXTRA)

"""Trial-balance gate (A2, J2, J6, J7, A8), scoped by batch.

Lines carry ``geo`` and ``ledger_source``. The trial balance is a table
(geo, account, opening, activity); an empty one skips the account check.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fxlake.functions.scalar import safe_amount
from fxlake.schema import ISSUE_SCHEMA, SUM_TYPE
from fxlake.session import stage_table

TB_SCHEMA = T.StructType([
    T.StructField("geo", T.StringType()),
    T.StructField("account", T.StringType()),
    T.StructField("opening", SUM_TYPE),
    T.StructField("activity", SUM_TYPE),
])


def unbalanced_geo_source(lines: DataFrame) -> DataFrame:
    """(batch, geo, ledger_source) whose accounted debits and credits differ, with the difference (A2)."""
    geo = F.coalesce(F.col("geo"), F.lit("UNKNOWN")).alias("geo")
    src = F.coalesce(F.col("ledger_source"), F.lit("UNKNOWN")).alias("ledger_source")
    sums = lines.groupBy("batch_id", geo, src).agg(
        F.sum(safe_amount("accounted_dr")).alias("accounted_dr"),
        F.sum(safe_amount("accounted_cr")).alias("accounted_cr"))
    return (sums.filter(F.col("accounted_dr") != F.col("accounted_cr"))
                .withColumn("diff", (F.col("accounted_dr") - F.col("accounted_cr")).cast(SUM_TYPE))
                .withColumns({c: F.col(c).cast(SUM_TYPE) for c in ("accounted_dr", "accounted_cr")}))


def unknown_accounts(lines: DataFrame, tb: DataFrame) -> DataFrame:
    """Lines whose account is missing from the trial balance of their geo.

    Skipped: an empty account, a geo without trial-balance rows. Spark broadcasts
    a small trial balance; otherwise the anti-join shuffles on (geo, account) and
    AQE splits skewed partitions.
    """
    tb_pairs = tb.select("geo", "account").distinct()
    tb_geos = tb.select("geo").distinct()
    acct = F.col("segment3_account")
    return (lines.filter(acct.isNotNull() & (acct != F.lit("")))
                 .select("batch_id", "geo", acct.alias("account"), "journal_id", "journal_line_num")
                 .join(tb_geos, "geo", "left_semi")
                 .join(tb_pairs, ["geo", "account"], "left_anti"))


def missing_geos(lines: DataFrame, expected_geos: list[str]) -> DataFrame:
    """(batch, geo) for each expected geo without any line in the batch.

    Expected pairs are generated per batch from the parameter list (no cross
    join); present pairs are a distinct with map-side partial aggregation.
    """
    present = lines.select("batch_id", "geo").distinct()
    batches = lines.select("batch_id").distinct()
    expected = batches.select("batch_id", F.explode(F.array(*[F.lit(g) for g in expected_geos])).alias("geo"))
    return expected.join(present, ["batch_id", "geo"], "left_anti")


def net_movement_exceeded(lines: DataFrame, tb: DataFrame) -> DataFrame:
    """(batch, geo, account) whose |debits - credits| exceeds opening + activity."""
    acct = F.col("segment3_account").alias("account")
    net = lines.groupBy("batch_id", "geo", acct).agg(
        F.abs(F.sum(safe_amount("accounted_dr")) - F.sum(safe_amount("accounted_cr"))).cast(SUM_TYPE)
        .alias("net_movement"))
    limits = tb.select("geo", "account",
                       (F.col("opening") + F.col("activity")).cast(SUM_TYPE).alias("limit"))
    return (net.join(limits, ["geo", "account"])
               .filter(F.col("net_movement") > F.col("limit")))


def _by_account(lines: DataFrame) -> DataFrame:
    """One row per (batch, geo, source, account): what every check but the line-wise one needs. The only pass over the lines."""
    return (lines.groupBy("batch_id", "geo", "ledger_source", F.col("segment3_account").alias("account"))
            .agg(F.count(F.lit(1)).alias("n"), F.sum(safe_amount("accounted_dr")).alias("accounted_dr"),
                 F.sum(safe_amount("accounted_cr")).alias("accounted_cr")))


def _counts(small: DataFrame, tb: DataFrame, expected_geos: list[str]) -> list[DataFrame]:
    """(batch_id, check, n) of each check, from the table of ``_by_account``."""
    unknown = [F.coalesce(F.col(c), F.lit("UNKNOWN")).alias(c) for c in ("geo", "ledger_source")]
    dr, cr = F.sum("accounted_dr"), F.sum("accounted_cr")

    def count(df: DataFrame, check: str, n: Column) -> DataFrame:
        return df.groupBy("batch_id").agg(n.cast("long").alias("n")).select("batch_id", F.lit(check).alias("check"), "n")

    unbalanced = small.groupBy("batch_id", *unknown).agg(dr.alias("d"), cr.alias("c")).where("d <> c")
    accounts = (small.where("account IS NOT NULL AND account <> ''").join(tb.select("geo").distinct(), "geo", "left_semi")
                .join(tb.select("geo", "account").distinct(), ["geo", "account"], "left_anti"))
    limits = tb.select("geo", "account", (F.col("opening") + F.col("activity")).cast(SUM_TYPE).alias("limit"))
    net = (small.groupBy("batch_id", "geo", "account").agg(F.abs(dr - cr).cast(SUM_TYPE).alias("net"))
           .join(limits, ["geo", "account"]).where(F.col("net") > F.col("limit")))
    return [count(unbalanced, "n_unbalanced", F.count("*")), count(accounts, "n_unknown_accounts", F.sum("n")),
            count(missing_geos(small, expected_geos), "n_missing_geos", F.count("*")), count(net, "n_net_movement", F.count("*"))]


CHECKS = ["n_unbalanced", "n_unknown_accounts", "n_missing_geos", "n_net_movement"]


def _summary(batches: DataFrame, counts: DataFrame) -> DataFrame:
    wide = counts.groupBy("batch_id").pivot("check", CHECKS).agg(F.sum("n"))
    out = batches.join(wide, "batch_id", "left").fillna(0, CHECKS)
    # Geo completeness is one issue listing every missing geo.
    total = (F.col("n_unbalanced") + F.col("n_unknown_accounts")
             + (F.col("n_missing_geos") > 0).cast("long") + F.col("n_net_movement"))
    return out.select("batch_id", *CHECKS, total.alias("issue_count"), (total == 0).alias("is_valid"))


def summary(lines: DataFrame, tb: DataFrame, expected_geos: list[str]) -> DataFrame:
    """Per batch: issue counts per check, ``issue_count`` and ``is_valid`` (A8). Reads the lines once."""
    small = stage_table(_by_account(lines), "tb-accounts")
    counts = _counts(small, tb, expected_geos)
    every = counts[0]
    for df in counts[1:]:
        every = every.unionByName(df)
    return _summary(small.select("batch_id").distinct(), every)


def issues(lines: DataFrame, tb: DataFrame, expected_geos: list[str]) -> DataFrame:
    """One row per finding of the gate, with ``ISSUE_SCHEMA`` (S13, F3); missing geos are a row each."""
    def rows(df: DataFrame, check: str, kind: str, column: Column, detail: Column, line: bool = False) -> DataFrame:
        return df.select("batch_id", F.lit(check).alias("check"), F.lit(kind).alias("issue_type"),
                         F.col("journal_id") if line else F.lit(None).cast("string").alias("journal_id"),
                         F.col("journal_line_num") if line else F.lit(None).cast("int").alias("journal_line_num"),
                         column.alias("column"), detail.alias("detail"))

    text = lambda c: F.col(c).cast("string")
    parts = [
        rows(unbalanced_geo_source(lines), CHECKS[0], "dr_cr_imbalance", F.concat_ws("/", "geo", "ledger_source"),
             F.format_string("accounted_dr=%s accounted_cr=%s diff=%s", text("accounted_dr"), text("accounted_cr"), text("diff"))),
        rows(unknown_accounts(lines, tb), CHECKS[1], "unknown_account", F.col("geo"), F.col("account"), line=True),
        rows(missing_geos(lines, expected_geos), CHECKS[2], "missing_geo", F.lit("geo"), F.col("geo")),
        rows(net_movement_exceeded(lines, tb), CHECKS[3], "net_movement", F.concat_ws("/", "geo", "account"),
             F.format_string("net_movement=%s limit=%s", text("net_movement"), text("limit")))]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.select(*[F.col(f.name).cast(f.dataType) for f in ISSUE_SCHEMA.fields])


def summary_of_issues(batches: DataFrame, found: DataFrame) -> DataFrame:
    """``summary`` from the issue rows; ``batches`` lists the batches to report."""
    return _summary(batches.select("batch_id").distinct(), found.groupBy("batch_id", "check").agg(F.count("*").alias("n")))


TB_JSON_TYPE = "map<string, map<string, struct<opening: string, activity: string>>>"


def read_trial_balance(spark: SparkSession, path: str | None) -> DataFrame:
    """Trial balance ``{geo: {account: {opening, activity}}}`` JSON to rows (S7); empty if absent.

    Each file is one JSON document (read whole); the nested maps are exploded,
    so the result is an ordinary (geo, account, opening, activity) table.
    """
    if not path:
        return spark.createDataFrame([], TB_SCHEMA)
    docs = spark.read.text(path, wholetext=True)
    parsed = docs.select(F.from_json("value", TB_JSON_TYPE).alias("tb"))
    geos = parsed.select(F.explode("tb").alias("geo", "accounts"))
    accts = geos.select("geo", F.explode("accounts").alias("account", "v"))
    return accts.select("geo", "account",
                        safe_amount("v.opening").cast(SUM_TYPE).alias("opening"),
                        safe_amount("v.activity").cast(SUM_TYPE).alias("activity"))

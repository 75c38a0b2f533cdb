from decimal import Decimal
import hashlib

from pyspark.sql import functions as F

from fxlake.functions import (
    booking_reference,
    date_prefix,
    file_stem,
    is_blank,
    payload_hash,
    period_name,
    is_lost_amount,
    safe_amount,
    surrogate_key,
)
from fxlake.schema import PAYLOAD_COLUMNS


def test_surrogate_key_null_amount_is_zero_text(spark):
    df = spark.createDataFrame(
        [("AR_FX", "J1", 1, "2024-01-31", None)],
        "source_system string, journal_id string, journal_line_num int, effective_date string, entered_dr string")
    got = df.select(surrogate_key().alias("k")).first().k
    assert got == hashlib.md5("AR_FX||J1||1||2024-01-31||0".encode()).hexdigest()


def test_surrogate_key_null_identifier_is_empty_text(spark):
    df = spark.createDataFrame(
        [("AR_FX", None, None, None, "5.0000")],
        "source_system string, journal_id string, journal_line_num int, effective_date string, entered_dr string")
    got = df.select(surrogate_key().alias("k")).first().k
    assert got == hashlib.md5("AR_FX||||||||5.0000".encode()).hexdigest()


def test_payload_hash_nulls_are_empty(spark):
    schema = ", ".join(f"{c} string" for c in PAYLOAD_COLUMNS)
    row = tuple(None if i % 2 else f"v{i}" for i in range(len(PAYLOAD_COLUMNS)))
    df = spark.createDataFrame([row], schema)
    text = "||".join("" if v is None else v for v in row)
    assert df.select(payload_hash().alias("h")).first().h == hashlib.sha256(text.encode()).hexdigest()


def test_period_name_upper_and_null(spark):
    df = spark.createDataFrame([("2024-01-31",), (None,)], "d string").select(F.col("d").cast("date").alias("d"))
    assert [r.p for r in df.select(period_name("d").alias("p")).collect()] == ["JAN-2024", None]


def test_date_prefix_takes_first_ten_chars(spark):
    df = spark.createDataFrame([("2024-02-29T10:11:12",), ("garbage",), ("",)], "t string")
    got = [r.d for r in df.select(date_prefix("t").alias("d")).collect()]
    assert str(got[0]) == "2024-02-29" and got[1] is None and got[2] is None


def test_safe_amount_treats_blank_null_and_garbage_as_zero(spark):
    df = spark.createDataFrame([("1.5",), ("",), ("null",), ("abc",), (None,), ("-2.25",)], "a string")
    got = [r.v for r in df.select(safe_amount("a").alias("v")).collect()]
    assert got == [Decimal("1.5"), 0, 0, 0, 0, Decimal("-2.25")]


def test_safe_amount_keeps_large_and_fine_amounts(spark):
    texts = ["12345678901234567.00", "0.00004", "9999999999999999.9999"]
    df = spark.createDataFrame([(t,) for t in texts], "a string")
    assert [r.v for r in df.select(safe_amount("a").alias("v")).collect()] == [Decimal(t) for t in texts]
    assert [r.v for r in df.select(is_lost_amount("a").alias("v")).collect()] == [True, True, False]


def test_is_blank(spark):
    df = spark.createDataFrame([("",), ("  ",), (None,), ("x",)], "a string")
    assert [r.b for r in df.select(is_blank("a").alias("b")).collect()] == [True, True, True, False]


def test_file_stem(spark):
    df = spark.createDataFrame([("s3://b/landing/ar_fx/batch_2024_01.json",), ("/x/y/z.csv",)], "p string")
    assert [r.s for r in df.select(file_stem("p").alias("s")).collect()] == ["batch_2024_01", "z"]


def test_booking_reference_is_deterministic(spark):
    df = spark.createDataFrame([("je-monthly-2024-01-31",)], "b string")
    r1 = df.select(booking_reference("b", F.lit("QUARTERLY")).alias("r")).first().r
    r2 = df.select(booking_reference("b", F.lit("QUARTERLY")).alias("r")).first().r
    assert r1 == r2 and r1.startswith("OFA-QUA-je-month-") and len(r1.split("-")[-1]) == 6

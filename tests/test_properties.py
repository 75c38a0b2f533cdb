"""Property tests (hypothesis) for the operators whose invariants matter at scale."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from fxlake.operators.dedup import keep_one_per_key
from fxlake.operators.numbering import number_within
from fxlake.operators.quality import quarantine_split

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

rows_strategy = st.lists(
    st.tuples(st.sampled_from(["k1", "k2", "k3", "hot"]), st.text("ab", min_size=1, max_size=3),
              st.integers(1, 2)),
    min_size=1, max_size=40)


@SETTINGS
@given(rows=rows_strategy)
def test_keep_one_per_key_keeps_the_minimum_of_each_key(spark, rows):
    df = spark.createDataFrame(rows, "surrogate_key string, payload_hash string, delivery int")
    got = {r.surrogate_key: (r.payload_hash, r.delivery)
           for r in keep_one_per_key(df, "surrogate_key", ["payload_hash", "delivery"]).collect()}
    want = {}
    for k, h, d in rows:
        want[k] = min(want.get(k, (h, d)), (h, d))
    assert got == want


@SETTINGS
@given(groups=st.lists(st.sampled_from(["a", "b", "hot"]), min_size=1, max_size=60),
       parts=st.integers(1, 6))
def test_number_within_equals_row_number(spark, groups, parts):
    df = spark.createDataFrame([(g, i) for i, g in enumerate(groups)], "g string, o long")
    got = number_within(df, ["g"], ["o"], out="n", partitions=parts)
    ref = df.withColumn("n", F.row_number().over(Window.partitionBy("g").orderBy("o")))
    assert sorted(map(tuple, got.select("g", "o", "n").collect())) == \
        sorted(map(tuple, ref.select("g", "o", "n").collect()))


@SETTINGS
@given(rows=st.lists(st.tuples(st.one_of(st.none(), st.text("xy", max_size=2)),
                               st.one_of(st.none(), st.integers(0, 3))), min_size=1, max_size=30))
def test_quarantine_split_partitions_the_input(spark, rows):
    df = spark.createDataFrame(rows, "a string, b int")
    valid, bad = quarantine_split(df, ["a", "b"])
    assert valid.count() + bad.count() == len(rows)
    assert valid.filter(F.col("a").isNull() | F.col("b").isNull()).count() == 0
    assert bad.filter(F.col("quarantine_reason") == "").count() == 0

"""Column arithmetic, with properties checked by hypothesis."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from transitlens.functions import geometry as G


def test_fraction_table(spark):
    df = spark.createDataFrame([(t,) for t in [None, -5, 0, 90, 180, 500]], "t int")
    got = [r.f for r in df.select(G.progress_fraction(F.col("t")).alias("f")).collect()]
    assert got == [None, 1.0, 1.0, 0.5, 0.0, 0.0]


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.integers(min_value=-10_000, max_value=10_000), min_size=2, max_size=60))
def test_fraction_in_unit_interval_and_non_increasing(spark, ts):
    ts = sorted(set(ts))
    df = spark.createDataFrame([(t,) for t in ts], "t int")
    fs = [r.f for r in df.select(G.progress_fraction(F.col("t")).alias("f")).orderBy("t").collect()]
    assert all(0.0 <= f <= 1.0 for f in fs)
    assert all(a >= b for a, b in zip(fs, fs[1:]))


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.floats(-90, 90), st.floats(-90, 90), st.floats(0, 1)), min_size=1, max_size=50))
def test_interpolated_point_between_ends(spark, rows):
    df = spark.createDataFrame(rows, "a double, b double, f double")
    for r in df.select("a", "b", G.interpolate("a", "b", "f").alias("p")).collect():
        lo, hi = min(r.a, r.b), max(r.a, r.b)
        assert lo - 1e-9 <= r.p <= hi + 1e-9


def test_interpolate_null_end(spark):
    df = spark.createDataFrame([(1.0, None, 0.5)], "a double, b double, f double")
    assert df.select(G.interpolate("a", "b", "f").alias("p")).first().p is None


def test_hex_rgb(spark):
    df = spark.createDataFrame([("#B36305",), ("#000000",), ("#95CDBA",)], "h string")
    got = [r.c for r in df.select(G.hex_rgb("h").alias("c")).collect()]
    assert got == [[179, 99, 5, 180], [0, 0, 0, 180], [149, 205, 186, 180]]

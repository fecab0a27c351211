"""Property tests with small generated inputs."""

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stratum.operators import aggregates as A
from stratum.operators import profile as P
from stratum.operators import windows as W

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from("abc"), st.integers(2000, 2010), st.floats(-100, 100)), min_size=1,
                max_size=30, unique_by=lambda t: (t[0], t[1])))
def test_deltas_telescope(spark, rows):
    df = spark.createDataFrame(rows, "e string, y int, v double")
    d = W.delta_previous(df, "e", "y", ["v"]).collect()
    for e in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == e), key=lambda r: r[1])
        total = sum(x["delta_v"] for x in d if x["e"] == e and x["delta_v"] is not None)
        assert math.isclose(total, mine[-1][2] - mine[0][2], abs_tol=1e-9)
        assert sum(1 for x in d if x["e"] == e and x["delta_v"] is None) == 1


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 3), st.sampled_from("xyz")), min_size=1, max_size=40))
def test_entropy_zero_iff_pure(spark, rows):
    df = spark.createDataFrame(rows, "c int, l string")
    h = A.cluster_entropy(df, "c", "l").first()[0]
    pure = all(len({l for c2, l in rows if c2 == c}) == 1 for c, _ in rows)
    assert (abs(h) < 1e-12) == pure


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 5), st.sampled_from(["s0", "s1", "s2"]), st.floats(-50, 50)), min_size=1,
                max_size=40, unique_by=lambda t: (t[0], t[1])))
def test_pivot_unpivot_round_trip(spark, rows):
    df = spark.createDataFrame(rows, "k int, s string, v double")
    wide = A.pivot_mean(df, ["k"], "s", ["s0", "s1", "s2"], "v")
    long = wide.unpivot("k", ["s0", "s1", "s2"], "s", "v").where(F.col("v").isNotNull())
    got = sorted((r["k"], r["s"], r["v"]) for r in long.collect())
    assert got == sorted(rows)


@SETTINGS
@given(st.lists(st.floats(-1e3, 1e3), min_size=1, max_size=60), st.integers(1, 12))
def test_histogram_counts_every_value(spark, xs, bins):
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    h = P.histogram(df, "x", bins).collect()
    assert sum(r["n"] for r in h) == len(xs)
    assert all(0 <= r["bin"] < bins for r in h)

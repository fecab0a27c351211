import datetime as dt
import math

from pyspark.sql import functions as F

from stratum.functions import scalar as S
from stratum.functions import stats as ST
from stratum.functions.exact_tests import fisher_p, hardy_weinberg_p


def test_clock_arithmetic(spark):
    df = spark.createDataFrame([(724, 43.0), (2355, 43.0), (724, -10.5)], "t int, d double")
    got = [r[0] for r in df.select(S.predicted_arrival("t", "d")).collect()]
    # 7:24 + 37.96 min -> 8:01; 23:55 + 37.96 -> 00:32; 7:24 - 16.61 min -> 7:07
    assert got == [801, 32, 707]


def test_labelled_buckets(spark):
    edges = [-100, -10, 0, 10, 20, 30, 40, 50, 100]
    labels = ['-100 to -10', '-10 to 0', '0 to 10', '10 to 20', '20 to 30', '30 to 40', '40 to 50', '50 to 100']
    vals = [-100.0, -10.0, 0.0, 99.0, 100.0, 101.0, -101.0, None]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r[0] for r in df.select(S.labelled_bucket("x", edges, labels)).collect()]
    assert got == ['-100 to -10', '-10 to 0', '0 to 10', '50 to 100', '50 to 100', None, None, None]


def test_unhot(spark):
    df = spark.createDataFrame([(0.0, 0.0, 1.0, 0.0), (0.0, 0.0, 0.0, 0.0)], "a double, b double, c double, d double")
    assert [r[0] for r in df.select(S.unhot(["a", "b", "c", "d"])).collect()] == [2, -1]


def test_nearest_30s(spark):
    ts = [dt.datetime(2024, 1, 1, 0, 0, s) for s in (14, 15, 44)]
    df = spark.createDataFrame([(t,) for t in ts], "ts timestamp")
    got = [r[0] for r in df.select(S.round_to_nearest_seconds("ts", 30)).collect()]
    assert got == [dt.datetime(2024, 1, 1, 0, 0, 0), dt.datetime(2024, 1, 1, 0, 0, 30), dt.datetime(2024, 1, 1, 0, 0, 30)]


def test_rms_distance(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0], [1.0, 2.0, 6.0])], "a array<double>, b array<double>")
    got = df.select(F.sqrt(S.squared_distance("a", "b")).alias("d")).first()[0]
    assert abs(got - 3.0) < 1e-12  # sqrt(9); RMS divides by sqrt(3)
    assert abs(df.select(S.rms_distance("a", "b")).first()[0] - math.sqrt(3.0)) < 1e-12


def test_great_circle_endpoints(spark):
    df = spark.createDataFrame([(10.0, 20.0, -30.0, 40.0)], "lo1 double, la1 double, lo2 double, la2 double")
    pts = df.select(F.explode(S.great_circle_points("lo1", "la1", "lo2", "la2", 100)).alias("p")).select("p.*").collect()
    assert len(pts) == 102
    assert abs(pts[0]["lon"] - 10) < 1e-9 and abs(pts[0]["lat"] - 20) < 1e-9
    assert abs(pts[-1]["lon"] + 30) < 1e-9 and abs(pts[-1]["lat"] - 40) < 1e-9


def test_fisher_equals_all_tables(spark):
    from fractions import Fraction

    def by_tables(a, b, c, d):
        each = {k: Fraction(math.comb(a + b, k) * math.comb(c + d, a + c - k)) for k in range(max(0, a - d), min(a + b, a + c) + 1)}
        return float(sum(p for p in each.values() if p <= each[a]) / sum(each.values()))

    tables = [(3, 1, 1, 3), (1, 3, 3, 1), (0, 0, 5, 7), (10, 2, 3, 15), (0, 9, 4, 0), (120, 80, 60, 140), (7, 0, 0, 0), (30, 10, 8, 33)]
    df = spark.createDataFrame([(*t, i) for i, t in enumerate([*tables, (0, 0, 0, 0), (40_000, 1, 2, 50_000)])], "a long, b long, c long, d long, i int")
    got = {r.i: r.p for r in df.select("i", fisher_p("a", "b", "c", "d").alias("p")).collect()}
    assert all(abs(got[i] - by_tables(*t)) < 1e-12 for i, t in enumerate(tables))
    assert got[len(tables)] is None and got[len(tables) + 1] == 0.0


def test_hardy_weinberg_equals_all_tables(spark):
    from fractions import Fraction

    def by_tables(aa, ab, bb):
        n, minor = aa + ab + bb, 2 * min(aa, bb) + ab
        ways = {h: Fraction(2 ** h * math.factorial(n), math.factorial((minor - h) // 2) * math.factorial(h) * math.factorial(n - (minor + h) // 2))
                for h in range(minor % 2, minor + 1, 2)}
        return float(sum(p for p in ways.values() if p <= ways[ab]) / sum(ways.values()))

    counts = [(25, 50, 25), (50, 0, 50), (10, 80, 10), (1, 2, 3), (0, 0, 9), (0, 1, 9), (3, 11, 90), (0, 30, 0), (57, 14, 50)]
    df = spark.createDataFrame([(*t, i) for i, t in enumerate([*counts, (0, 0, 0)])], "a long, h long, b long, i int")
    got = {r.i: r.p for r in df.select("i", hardy_weinberg_p("a", "h", "b").alias("p")).collect()}
    assert all(abs(got[i] - by_tables(*t)) < 1e-12 for i, t in enumerate(counts)) and got[len(counts)] is None


def test_t_tail():
    p = ST.t_two_sided_p([2.0, 0.0], [10, 5])
    assert abs(p[0] - 0.0733880347707) < 1e-9
    assert abs(p[1] - 1.0) < 1e-12
    assert abs(ST.t_two_sided_p([1.0], [1])[0] - 0.5) < 1e-12 and abs(ST.t_two_sided_p([3.0], [2])[0] - (1 - 3 / math.sqrt(11))) < 1e-12
    z = 5.5  # many degrees of freedom: the normal tail, corrected by its first-order term
    normal = math.erfc(z / math.sqrt(2)) + 2 * math.exp(-z * z / 2) / math.sqrt(2 * math.pi) * (z ** 3 + z) / (4 * 1e8)
    assert abs(ST.t_two_sided_p([z], [1e8])[0] / normal - 1) < 1e-6
    far = ST.t_two_sided_p([40.0, float("nan")], [30, 5])
    assert 0 < far[0] < 1e-26 and math.isnan(far[1])

"""Variant files with their sample names, the compacted keyed table, clusterings judged by labels."""

import math
import os

import numpy as np
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from stratum.operators import ml as ML
from stratum.sources import readers as RD
from stratum.streaming import sensors as ST

HEAD = "\t".join("#CHROM POS ID REF ALT QUAL FILTER INFO FORMAT".split())


def test_vcf_sample_names_per_file_and_folder(spark, tmp_path):
    one = ["##fileformat=VCFv4.2", f"{HEAD}\tNA1\tNA2", "1\t100\t.\tA\tG\t.\tPASS\t.\tGT:GQ:AD\t0/1:30:5,6\t./.:3:0,0",
           "1\t100\t.\tA\tT,C\t.\tPASS\t.\tGT:AD:GQ\t1|2:1,2,3:40\t0/0:9,0,0:99", "Y\t8\t.\tG\tA\t.\tPASS\t.\tGT:GQ:AD\t.\t0/1", "X\t7\t.\tG\tA\t.\tPASS\t.\tGT\t1\t."]
    (tmp_path / "own").mkdir()
    (tmp_path / "own" / "a.vcf").write_text("\n".join(one) + "\n")
    (tmp_path / "own" / "b.vcf").write_text(f"{HEAD}\tNB\n2\t5\t.\tC\tT\t.\t.\t.\tGT:GQ\t1/1:50\n")
    variants, g = RD.read_vcf(spark, str(tmp_path / "own"))
    got = {(r.contig, r.pos, r.alt, r.sample_id): (r.sample_index, r.alleles, r.gq, r.ad) for r in g.collect()}
    assert got == {("1", 100, "G", "NA1"): (0, [0, 1], 30, [5, 6]), ("1", 100, "G", "NA2"): (1, None, 3, [0, 0]),
                   ("1", 100, "T,C", "NA1"): (0, [1, 2], 40, [1, 2, 3]), ("1", 100, "T,C", "NA2"): (1, [0, 0], 99, [9, 0, 0]),
                   ("Y", 8, "A", "NA1"): (0, None, None, None), ("Y", 8, "A", "NA2"): (1, [0, 1], None, None),
                   ("X", 7, "A", "NA1"): (0, [1], None, None), ("X", 7, "A", "NA2"): (1, None, None, None), ("2", 5, "T", "NB"): (0, [1, 1], 50, None)}
    assert variants.count() == 5 and [r.alts for r in variants.where("alt = 'T,C'").collect()] == [["T", "C"]]
    os.makedirs(tmp_path / "parts")  # one header for the part files of a folder
    (tmp_path / "parts" / "part-0").write_text("\n".join(one[:3]) + "\n")
    (tmp_path / "parts" / "part-1").write_text("\n".join(one[3:]) + "\n")
    parts = RD.read_vcf(spark, str(tmp_path / "parts"))[1]
    assert {(r.contig, r.alt, r.sample_id) for r in parts.collect()} == {(c, a, s) for c, _, a, s in got if c != "2"}
    (tmp_path / "none.vcf").write_text("3\t1\t.\tA\tC\t.\t.\t.\tGT\t0/0\n")
    assert RD.read_vcf(spark, str(tmp_path / "none.vcf"))[1].first().sample_id is None


def test_keyed_totals_survive_replays_and_compaction(spark, tmp_path):
    def batch(rows):
        return spark.createDataFrame(rows, "k string, total double, n long")

    store = ST.KeyedTotals(spark, str(tmp_path / "store"), ["k"], ["total", "n"], "k string, total double, n long")
    first, second, third = [("a", 1.0, 1), ("a", 2.0, 1), (None, 5.0, 1)], [("a", 10.0, 1), ("b", None, 1)], [("b", 4.0, 1), ("a", 0.5, 1)]

    def read():
        return {r.k: (r.total, r.n) for r in store.read().collect()}

    store.write(batch(first), 0)
    store.write(batch(first), 0)  # replayed before a compaction
    store.write(batch(second), 1)
    half = {"a": (13.0, 3), "b": (None, 1), None: (5.0, 1)}
    assert read() == half and store.compact() == 1 and read() == half
    store.write(batch(second), 1)  # replayed after it was folded in
    assert read() == half and store.compact() == 1
    store.write(batch(third), 2)
    whole = {"a": (13.5, 4), "b": (4.0, 2), None: (5.0, 1)}
    assert read() == whole
    # a compaction that wrote its base but was lost before the log
    batch([("a", 999.0, 9)]).write.parquet(str(tmp_path / "store" / "base" / "upto=2"))
    assert read() == whole and store.compact() == 2 and read() == whole
    again = ST.KeyedTotals(spark, str(tmp_path / "store"), ["k"], ["total", "n"], "k string, total double, n long")
    assert {r.k: (r.total, r.n) for r in again.read().collect()} == whole


def test_kmeans_entropy_sweep(spark):
    rnd = np.random.default_rng(1)
    rows = [(float(x), float(y), c) for c, (mx, my) in enumerate([(0, 0), (9, 0), (0, 9)]) for x, y in rnd.normal(size=(30, 2)) * 0.3 + [mx, my]]
    df = ML.vectors(spark.createDataFrame([([x, y], f"l{c if x < 9.2 else 0}") for x, y, c in rows], "v array<double>, label string"), "v", "scaled").cache()
    got = {r.k: r for r in ML.kmeans_entropy_sweep(df, [2, 3], "label").collect()}
    m = KMeans(k=3, maxIter=40, tol=1e-5, seed=42, featuresCol="scaled").fit(df)
    clusters = {}
    for r in m.transform(df).select("prediction", "label").collect():
        clusters.setdefault(r.prediction, []).append(r.label)
    entropy = sum(-sum(own.count(v) * math.log(own.count(v) / len(own)) for v in set(own)) for own in clusters.values()) / len(rows)
    assert abs(got[3].entropy - entropy) < 1e-12 and abs(got[3].cost_per_row - m.summary.trainingCost / len(rows)) < 1e-12
    assert got[2].entropy > got[3].entropy > 0 and df.where(F.col("label").isNull()).count() == 0


def test_delimited_fields_that_are_not_of_their_type(spark, tmp_path):
    from stratum.sources import readers as RD

    (tmp_path / "a.txt").write_text("2020-01-02|Fan-belt, worn!|12\nnever|OK.| 7 |more\n2020-02-30||x\n2020-03-04|short\n")
    got = RD.read_delimited_typed(spark, str(tmp_path), {"date": "date", "note": "string", "minutes": "int"}, strip={"note": "[.!?-]"}).collect()
    assert [(str(r["date"]), r["note"], r["minutes"]) for r in got] == [
        ("2020-01-02", "fanbelt, worn", 12), ("None", "ok", 7), ("None", None, None), ("2020-03-04", "short", None)]
    (tmp_path / "none").mkdir()
    assert RD.read_delimited_typed(spark, str(tmp_path / "none"), {"date": "date"}).count() == 0


def test_kmeans_sweeps_over_a_sort_merge_join(spark):
    """An aggregate on top of a sort-merge join, as the planner takes for tables too large to broadcast."""
    base = spark.range(400).select("id", (F.col("id") % 7).cast("double").alias("x"), (F.col("id") % 3).alias("label"))
    more = spark.range(1200).select((F.col("id") % 400).alias("id"), F.col("id").cast("double").alias("v"))
    joined = base.join(more.hint("merge"), "id", "left").groupBy("id", "x", "label").agg(F.sum("v").alias("y"))
    df = joined.withColumn("scaled", array_to_vector(F.array("x", "y")))
    got = ML.kmeans_entropy_sweep(df, [2, 3], "label").collect()
    assert [r.k for r in got] == [2, 3] and got[0].cost_per_row > got[1].cost_per_row > 0
    again = {r.k: r.cost_per_row for r in ML.kmeans_sweep(df, [2, 3]).collect()}
    assert all(abs(again[r.k] - r.cost_per_row) < 1e-6 * r.cost_per_row for r in got)


def test_vcf_lines_wider_than_a_piece(spark, tmp_path):
    """Samples of three pieces, one of them missing from a variant: each line has a column per sample, and no call carries the names."""
    from stratum.plans import q_io
    from stratum.plans.views import view

    n = 2 * q_io.VCF_PIECE + 10
    rows = [(o, v, s, 1 + (s + v) % 3, float(1 + (s * 7 + v) % 49)) for o, (v, s) in enumerate((v, s) for v in range(1, 4) for s in range(n) if v > 1 or s >= n // 2)]
    spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double").write.parquet(str(tmp_path / "lineitem.parquet"))
    text = [r.value.split("\t") for r in q_io._vcf_lines(spark, str(tmp_path)).collect()]
    head = next(t for t in text if t[0] == "#CHROM")
    lines = {t[0]: t[9:] for t in text if not t[0].startswith("#")}
    assert head[9:] == [str(s) for s in range(n)] and set(lines) == {"1", "2", "3"} and all(len(c) == n for c in lines.values())
    assert lines["1"][:n // 2] == ["."] * (n // 2) and [c.split(":")[0] for c in lines["2"][300:302]] == ["0/0", "0/1"]
    want = view(spark, str(tmp_path), "genotypes").where("gt is not null").groupBy("contig", "sample_id").agg(
        F.count("gt").alias("n_called"), F.sum("gt").alias("alt_alleles"), F.sum("gq").alias("sum_gq"))
    assert sorted(map(tuple, q_io.vcf_import(spark, str(tmp_path)).collect())) == sorted(map(tuple, want.collect()))
    (tmp_path / "a.vcf").write_text(f"{HEAD}\tNA1\tNA2\n1\t100\t.\tA\tG\t.\tPASS\t.\tGT\t0/1\t./.\n")
    plan = RD.read_vcf(spark, str(tmp_path / "a.vcf"))[1]._jdf.queryExecution().optimizedPlan().toString()
    assert "sample_index" in next(line for line in plan.split("\n") if "Join LeftOuter" in line)

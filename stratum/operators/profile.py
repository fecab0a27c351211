"""Distribution profiles (A10, A21–A30): describe, histograms, quantiles,
box-plot statistics, density, correlation, rank correlation, Q-Q table."""

from __future__ import annotations

import math

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def describe_long(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """count / mean / sample stddev / min / max per column, typed, in long form (one pass)."""
    aggs = []
    for c in cols:
        v = F.col(c).cast("double")
        aggs += [F.count(v).alias(f"{c}__n"), F.avg(v).alias(f"{c}__mean"), F.stddev_samp(v).alias(f"{c}__sd"),
                 F.min(v).alias(f"{c}__min"), F.max(v).alias(f"{c}__max")]
    wide = df.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("column_name"), F.col(f"{c}__n").alias("n"), F.col(f"{c}__mean").alias("mean"),
                     F.col(f"{c}__sd").alias("stddev"), F.col(f"{c}__min").alias("min"),
                     F.col(f"{c}__max").alias("max")) for c in cols]
    return wide.select(F.explode(F.array(*rows)).alias("_r")).select("_r.*")


def _bounds(df: DataFrame, col: str):
    """(min, max, count) of a column: one aggregate row fetched to the driver."""
    r = df.agg(F.min(col), F.max(col), F.count(col)).first()
    return r[0], r[1], r[2]


def histogram(df: DataFrame, col: str, bins: int, lo: float | None = None, hi: float | None = None,
              materialize: bool = False) -> DataFrame:
    """Exactly ``bins`` equal-width bins over [lo, hi] (data range by default); the last bin is closed.

    Returns (bin, lower, upper, n, density) with density = n / (N · width).
    Values outside [lo, hi] and NULLs are not counted. One partial-aggregated
    pass (plus one tiny aggregate when the range comes from the data).
    ``materialize`` checkpoints the one column first — worth it when the
    input is an expensive plan that the two passes would otherwise recompute.
    """
    if materialize:
        from stratum.session import cut_lineage

        df = cut_lineage(df.select(col))
    if lo is None or hi is None:
        dlo, dhi, _ = _bounds(df, col)
        lo = dlo if lo is None else lo
        hi = dhi if hi is None else hi
    if lo is None:
        return df.sparkSession.createDataFrame([], "bin int, lower double, upper double, n long, density double")
    lo, hi = float(lo), float(hi)
    span = hi - lo if hi > lo else 1.0
    x = F.col(col).cast("double")
    b = F.least(F.floor((x - F.lit(lo)) * F.lit(float(bins)) / F.lit(span)), F.lit(bins - 1)).cast("int")
    inside = df.where((x >= lo) & (x <= hi)).select(b.alias("bin"))
    counts = inside.groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window_all())
    w = span / bins
    return counts.select("bin", (F.lit(lo) + F.col("bin") * F.lit(w)).alias("lower"),
                         (F.lit(lo) + (F.col("bin") + 1) * F.lit(w)).alias("upper"), "n",
                         (F.col("n") / (total * F.lit(w))).alias("density"))


def Window_all():
    """Window over a *bounded* aggregate table (≤ bins rows), never over raw rows."""
    from pyspark.sql import Window

    return Window.partitionBy()


def hist2d(df: DataFrame, x: str, y: str, bins: int, materialize: bool = False) -> DataFrame:
    """Square 2-D binning (hexbin / joint-plot data): counts per (xbin, ybin) over the data range.

    ``materialize`` checkpoints the two columns first so the range pass and the
    binning pass do not both recompute an expensive input plan.
    """
    if materialize:
        from stratum.session import cut_lineage

        df = cut_lineage(df.select(x, y))
    r = df.agg(F.min(x), F.max(x), F.min(y), F.max(y)).first()
    if r[0] is None:
        return df.sparkSession.createDataFrame([], "xbin int, ybin int, n long")

    def b(c, lo, hi):
        span = float(hi - lo) if hi > lo else 1.0
        return F.least(F.floor((F.col(c).cast("double") - F.lit(float(lo))) * F.lit(float(bins)) / F.lit(span)),
                       F.lit(bins - 1)).cast("int")

    s = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    return s.groupBy(b(x, r[0], r[1]).alias("xbin"), b(y, r[2], r[3]).alias("ybin")).agg(
        F.count(F.lit(1)).alias("n"))


def rank_within(df: DataFrame, group: Sequence[str], value: str, partitions: int | None = None) -> DataFrame:
    """0-based rank of every row by ``value`` within its group, without a single-task window.

    Range-partition on (group, value) so that a large group spans many tasks;
    rank locally per (partition, group); add the counts of the same group in
    earlier partitions (a small table). Rows of one value stay in one task:
    for values that repeat often use :func:`value_ranks`. The ranked data is
    cut from its lineage with a reliable checkpoint so both passes see the same
    partitioning after executor loss.
    """
    from pyspark.sql import Window

    from stratum.session import cut_lineage

    spark = df.sparkSession
    n_parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = list(group)
    x = df.where(F.col(value).isNotNull()).repartitionByRange(n_parts, *keys, value)
    x = x.withColumn("_pid", F.spark_partition_id())
    w = Window.partitionBy("_pid", *keys).orderBy(value)
    x = cut_lineage(x.withColumn("_local", F.row_number().over(w) - 1))
    counts = x.groupBy("_pid", *keys).agg(F.count(F.lit(1)).alias("_cnt"))
    wo = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = counts.withColumn("_off", F.coalesce(F.sum("_cnt").over(wo), F.lit(0))).drop("_cnt")
    return x.join(offs, ["_pid", *keys]).withColumn("rank", (F.col("_off") + F.col("_local")).cast("long")) \
        .drop("_pid", "_local", "_off")


def value_ranks(df: DataFrame, group: Sequence[str], value: str, partitions: int | None = None) -> DataFrame:
    """(group, value, n, first): each distinct value with its number of rows and the 0-based rank of the first of them.

    Rows are counted per value before anything is moved, so a value that most rows share is one row from then on. The
    distinct values are range-partitioned; a running sum inside each partition plus the sums of the earlier partitions
    (one row per partition and group) gives the ranks. NULL values have none.
    """
    from pyspark.sql import Window

    from stratum.session import cut_lineage

    keys = list(group)
    cells = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))
    n_parts = [partitions] if partitions else []
    cells = cells.repartitionByRange(*n_parts, *keys, value).withColumn("_pid", F.spark_partition_id())
    local = Window.partitionBy("_pid", *keys).orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    cells = cut_lineage(cells.withColumn("_local", F.sum("n").over(local) - F.col("n")))
    sums = cells.groupBy("_pid", *keys).agg(F.sum("n").alias("_sum"))
    before = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("_pid", *keys, F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_off"))
    return cells.join(sums, ["_pid", *keys]).select(*keys, value, "n", (F.col("_off") + F.col("_local")).cast("long").alias("first"))


def expand_ranks(ranked: DataFrame, piece: int = 10_000) -> DataFrame:
    """One row per rank from :func:`value_ranks`: the ranks of a frequent value are dealt out in pieces before they expand."""
    last = F.col("first") + F.col("n") - 1
    pieces = ranked.withColumn("_from", F.explode(F.sequence(F.col("first"), last, F.lit(piece).cast("long"))))
    # a given number of partitions, which adaptive execution does not coalesce: the rows are few before they expand
    dealt = pieces.repartition(int(ranked.sparkSession.conf.get("spark.sql.shuffle.partitions")), "_from")
    return dealt.withColumn("rank", F.explode(F.sequence(F.col("_from"), F.least(last, F.col("_from") + piece - 1)))).drop("_from", "n", "first")


def exact_quantiles(df: DataFrame, group: Sequence[str], value: str, probs: Sequence[float]) -> DataFrame:
    """Exact linear-interpolation quantiles (R type 7 / ``percentile``) per group, scalable.

    The wanted ranks of a group (two a quantile) are looked up in the rank
    ranges of its distinct values (:func:`value_ranks`); no row is expanded.
    Output: (group…, p, q).
    """
    keys = list(group)
    ranked = value_ranks(df, keys, value)
    n = ranked.groupBy(*keys).agg(F.sum("n").alias("_n"))
    wanted = F.array(*[F.struct(F.lit(float(p)).alias("p"), (F.lit(float(p)) * (F.col("_n") - 1)).alias("pos")) for p in probs])
    found = ranked.join(n.select(*keys, wanted.alias("_w"), "_n"), keys)
    each = F.transform("_w", lambda w: F.struct(
        w["p"].alias("p"), w["pos"].alias("pos"), F.floor(w["pos"]).cast("long").alias("low"),
        F.least(F.floor(w["pos"]).cast("long") + 1, F.col("_n") - 1).alias("high")))
    inside = lambda r: (r >= F.col("first")) & (r < F.col("first") + F.col("n"))
    hits = F.filter(each, lambda w: inside(w["low"]) | inside(w["high"]))
    rows = found.select(*keys, F.col(value).alias("_v"), "first", "n", F.explode(hits).alias("_w"))
    rows = rows.groupBy(*keys, "_w.p", "_w.pos").agg(F.max(F.when(inside(F.col("_w.low")), F.col("_v"))).alias("_vlo"),
                                                      F.max(F.when(inside(F.col("_w.high")), F.col("_v"))).alias("_vhi"))
    frac = F.col("pos") - F.floor("pos")
    q = F.when(frac == 0, F.col("_vlo")).otherwise(F.col("_vlo") + frac * (F.col("_vhi") - F.col("_vlo")))
    return rows.select(*keys, "p", q.alias("q"))


def box_stats(df: DataFrame, group: Sequence[str], value: str) -> DataFrame:
    """min / Q1 / median / Q3 / max per group (whiskers at the extremes), exact."""
    keys = list(group)
    q = exact_quantiles(df, keys, value, [0.0, 0.25, 0.5, 0.75, 1.0])
    names = {0.0: "min", 0.25: "q1", 0.5: "median", 0.75: "q3", 1.0: "max"}
    return q.groupBy(*keys).pivot("p", list(names)).agg(F.first("q")).select(
        *keys, *[F.col(f"`{p}`").alias(n) for p, n in names.items()])


def bandwidth_nrd0(df: DataFrame, col: str) -> float:
    """Silverman's rule (R ``bw.nrd0``): 0.9·min(sd, IQR/1.34)·n^(−1/5); where both are zero, |value| or 1 stands for them."""
    s = df.agg(F.stddev_samp(col).alias("sd"), F.count(col).alias("n"), F.min(F.abs(col)).alias("least")).first()
    q = exact_quantiles(df.select(F.lit(0).alias("_g"), col), ["_g"], col, [0.25, 0.75]).orderBy("p").collect()
    iqr = q[1]["q"] - q[0]["q"]
    sd = s["sd"] or 0.0  # a single value has no deviation
    lo = min(sd, iqr / 1.34) if iqr > 0 else sd
    return 0.9 * (lo or float(s["least"]) or 1.0) * s["n"] ** (-0.2)


def kde_grid(df: DataFrame, col: str, n: int = 512, adjust: float = 1.0, cut: float = 3.0,
             bw: float | None = None) -> DataFrame:
    """Gaussian kernel density on an ``n``-point grid over [min − cut·bw, max + cut·bw].

    As R's ``density`` does, the data are first linearly binned onto the grid
    (each value splits its weight between the two nearest grid points) in one
    partial-aggregated pass, so the data-sized work is linear; the kernel sum
    then runs on the ≤ n binned weights × n grid points (a bounded table).
    A column without values gives an empty grid.
    """
    lo_v, hi_v, cnt = _bounds(df, col)
    if not cnt:
        return df.sparkSession.createDataFrame([], "i int, x double, density double")
    h = (bw if bw is not None else bandwidth_nrd0(df, col)) * adjust
    lo = lo_v - cut * h
    hi = hi_v + cut * h
    delta = (hi - lo) / (n - 1)
    x = F.col(col).cast("double")
    pos = (x - F.lit(lo)) / F.lit(delta)
    j = F.floor(pos).cast("int")
    fr = pos - j
    w = df.where(x.isNotNull()).select(j.alias("_j"), fr.alias("_f"))
    w = w.select(F.explode(F.array(F.struct(F.col("_j").alias("k"), (1 - F.col("_f")).alias("w")),
                                   F.struct((F.col("_j") + 1).alias("k"), F.col("_f").alias("w")))).alias("_s"))
    binned = w.select("_s.*").groupBy("k").agg(F.sum("w").alias("w")).where(F.col("k") < n)
    grid = binned.select("k", "w", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("g"))
    u = ((F.col("g") - F.col("k")) * F.lit(delta)) / F.lit(h)
    kern = F.exp(-0.5 * u * u) / F.lit((2 * 3.141592653589793) ** 0.5)
    dens = grid.groupBy("g").agg(F.sum(F.col("w") * kern).alias("_s"))
    return dens.select(F.col("g").alias("i"), (F.lit(lo) + F.col("g") * F.lit(delta)).alias("x"),
                       (F.col("_s") / F.lit(cnt * h)).alias("density"))


def correlation_long(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation of every column pair (a < b) in one aggregate pass, long form."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    wide = df.agg(*[F.corr(a, b).alias(f"{a}__{b}") for a, b in pairs])
    rows = [F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), F.col(f"{a}__{b}").alias("corr"))
            for a, b in pairs]
    return wide.select(F.explode(F.array(*rows)).alias("_r")).select("_r.*")


def kendall_tau_b(df: DataFrame, x: str, y: str, digit_bits: int = 4, wide: bool | None = None) -> DataFrame:
    """Exact Kendall τ-b of two numeric columns, distributed.

    S = n0 − n1 − n2 + n3 − 2D, where n1/n2/n3 are tied pairs in x / y / both
    (from group counts) and D is the number of discordant pairs. The distinct
    (x, y) cells are written with dense ranks in digits of ``digit_bits``
    bits. A pair that differs in both ranks has one highest differing digit
    in each, so it is counted at exactly one pair of levels, among the cells
    that agree in all higher digits of both ranks: a table of at most
    digits × digits counts. All levels are one aggregate (with map-side
    combine) by those higher digits; whatever the data, no group holds more
    than one table. The driver sees one row per range partition. Counts are whole numbers
    throughout, so ties are exact at any size: all pairs are counted in 64 bits where n(n−1) fits them, else in
    38 decimal digits (``wide`` asks for those at any size). NULL and NaN rows are left
    out; tau is NULL where either column is constant or there are no rows.
    """
    from stratum.session import cut_lineage

    size = 1 << digit_bits
    s = df.where(F.col(x).isNotNull() & F.col(y).isNotNull() & ~F.isnan(F.col(x).cast("double"))
                 & ~F.isnan(F.col(y).cast("double")))
    cells = cut_lineage(s.groupBy(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
                        .agg(F.count(F.lit(1)).alias("c")))
    big = lambda c: F.col(c).cast("decimal(19,0)")
    pairs = lambda c: F.sum(big(c) * (big(c) - 1)).cast("decimal(38,0)")  # noqa: E731  twice the tied pairs
    # the values of both axes in sorted ranges: a place in the range, and the sizes of the ranges before
    both = cells.select(F.explode(F.array(*[F.struct(F.lit(k).alias("axis"), F.col(v).alias("v")) for k, v in enumerate("xy")])).alias("_a"), "c")
    own = both.groupBy("_a.axis", "_a.v").agg(F.sum("c").alias("t")).repartitionByRange("axis", "v").sortWithinPartitions("axis", "v")
    own = cut_lineage(own.withColumn("_at", F.monotonically_increasing_id()))
    own = own.select("axis", "v", "t", F.shiftright("_at", 33).alias("_pid"), F.col("_at").bitwiseAND((1 << 33) - 1).alias("_place"))
    sums = own.groupBy("_pid", "axis").agg(F.count(F.lit(1)).alias("k"), F.min("_place").alias("_least"), pairs("t").alias("ties"))
    sums = sums.collect()  # one row per range and axis
    n, n3 = cells.agg(F.sum("c"), pairs("c")).first()
    if not n:
        return df.sparkSession.createDataFrame([(None, 0)], "tau_b double, n long")
    places, ends = [], [0, 0]
    for r in sorted(sums, key=lambda r: (r["axis"], r["_pid"])):
        places.append((r["_pid"], r["axis"], ends[r["axis"]] - r["_least"]))
        ends[r["axis"]] += r["k"]
    offsets = df.sparkSession.createDataFrame(places, "_pid long, axis int, _off long")
    ranks = own.join(F.broadcast(offsets), ["_pid", "axis"]).select("axis", "v", (F.col("_off") + F.col("_place")).alias("r"))
    ranked = (cells.join(ranks.where("axis = 0").select(F.col("v").alias("x"), F.col("r").alias("rx")), "x")
              .join(ranks.where("axis = 1").select(F.col("v").alias("y"), F.col("r").alias("ry")), "y").select("rx", "ry", "c"))
    levels = lambda most: range(max(1, -(-int(most).bit_length() // digit_bits)))
    at = ", ".join(f"struct({a} AS a, {b} AS b, shiftright(rx, {digit_bits * (a + 1)}) AS nx, shiftright(ry, {digit_bits * (b + 1)}) AS ny, "
                   f"shiftright(rx, {digit_bits * a}) & {size - 1} AS dx, shiftright(ry, {digit_bits * b}) & {size - 1} AS dy)"
                   for a in levels(ends[0] - 1) for b in levels(ends[1] - 1))
    rows = ranked.select("c", F.expr(f"inline(array({at}))"))
    sums_where = lambda sign: "array(" + ", ".join(f"coalesce(sum(CASE WHEN dy {sign} {k} THEN c END), 0L)" for k in range(size)) + ")"
    lines = rows.groupBy("a", "b", "nx", "ny", "dx").agg(F.expr(sums_where("=")).alias("own"), F.expr(sums_where(">")).alias("above"))
    table = lines.groupBy("a", "b", "nx", "ny").agg(F.array_sort(F.collect_list(F.struct("dx", "own", "above"))).alias("t")).where(F.size("t") > 1)
    whole, factor = ("decimal(38,0)", "decimal(19,0)") if wide or int(n) * (int(n) - 1) >= 1 << 63 else ("bigint", "bigint")
    # line by line, every count against those of a smaller x digit and a larger y digit
    fold = (f"aggregate(t, struct(cast(0 as {whole}) AS d, array_repeat(0L, {size}) AS above), (acc, l) -> struct("
            f"cast(acc.d + aggregate(zip_with(l.own, acc.above, (u, v) -> cast(u as {factor}) * cast(v as {factor})), "
            f"cast(0 as {whole}), (p, q) -> cast(p + q as {whole})) as {whole}) AS d, "
            "zip_with(acc.above, l.above, (u, v) -> u + v) AS above), acc -> acc.d)")
    discordant = table.agg(F.expr(f"coalesce(sum({fold}), 0)").alias("d"))
    n, n3, d = int(n), int(n3), int(discordant.first()[0])
    n1, n2 = (sum(int(r["ties"]) for r in sums if r["axis"] == axis) for axis in (0, 1))
    n0 = n * (n - 1)  # all of these twice the pairs
    den = math.sqrt(float((n0 - n1) * (n0 - n2)))
    tau = (n0 - n1 - n2 + n3 - 4 * d) / den if den > 0 else None
    return df.sparkSession.createDataFrame([(tau, n)], "tau_b double, n long")


def qq_table(df: DataFrame, p: str) -> DataFrame:
    """Q-Q table of p-values: NaN/NULL dropped, sorted ascending; expected −log10(i/n), observed −log10(p).

    The global order comes from :func:`value_ranks` (distinct values, range-partitioned), not a
    single-partition window; equal p-values are expanded into their ranks afterwards.
    """
    clean = df.where(F.col(p).isNotNull() & ~F.isnan(p)).select(F.lit(0).alias("_g"), F.col(p))
    cells = value_ranks(clean, ["_g"], p)
    n = cells.agg(F.sum("n")).first()[0] or 0
    ranked = expand_ranks(cells)
    i = F.col("rank") + 1
    return ranked.select(i.alias("i"), F.col(p).alias("p"), (-F.log10(i / F.lit(float(n)))).alias("expected"),
                         (-F.log10(F.col(p))).alias("observed"))

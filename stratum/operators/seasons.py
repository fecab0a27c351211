"""Entity-season scoring: dedup, two-pass z-scores, max-abs normalisation,
season deltas, prior-season pairs, next-season rows, cumulative similarity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.operators import clean, windows as W

# Output score order (first-pass percentages weighted by attempts, then counting stats).
SCORES = ["zfg", "zft", "ztp", "ztrb", "ztov", "zpts"]
NORMS = ["nfg", "nft", "ntp", "ntrb", "ntov", "npts"]


def dedup_seasons(raw: DataFrame, keys=("name", "year"), team: str = "team", total: str = "TOT") -> DataFrame:
    """One row per (entity, year): the total row wins, else the greatest team code."""
    return clean.preferred_row(raw, list(keys), F.col(team) == total, [F.col(team)])


#: All nine scores, in the order of summation.
NINE = ["zfg", "zft", "ztp", "ztrb", "zast", "zstl", "zblk", "ztov", "zpts"]


def score_seasons(players: DataFrame, year: str = "year", raw: Sequence[str] = ("tp", "trb", "pts", "tov"),
                  scores: Sequence[str] = SCORES) -> DataFrame:
    """Two-pass z-scores within each year, total, max-abs normalised scores and total.

    ``raw`` are the counting statistics, ``scores`` the scores in the order they are added up (``NINE`` with assists, steals
    and blocks among ``raw``).

    Pass 1: ``fg=(fgp−avg fgp)·fga``, ``ft=(ftp−avg ftp)·fta``; tp, trb, pts are
    population z-scores; tov is a negated z-score. Pass 2: z-score of fg, ft.
    Two aggregates and two joins in all: the second aggregate carries the first one's row per year along, and the greatest
    absolute score of a year follows from its smallest and greatest value, since a z-score is monotone in its value.
    """
    from stratum.session import cut_lineage

    # two passes read the same rows: materialise them once on shared storage
    players = cut_lineage(players)

    def moments(cols):
        return [a for c in cols for a in (F.avg(c).alias(f"_a_{c}"), F.stddev_pop(c).alias(f"_s_{c}"),
                                          F.min(c).alias(f"_lo_{c}"), F.max(c).alias(f"_hi_{c}"))]

    def z(value, c):
        return W.safe_div(value - F.col(f"_a_{c}"), F.col(f"_s_{c}"))

    def weighted(df):
        return (df.withColumn("fg", (F.col("fgp") - F.col("_afgp")) * F.col("fga"))
                  .withColumn("ft", (F.col("ftp") - F.col("_aftp")) * F.col("fta")))

    first = [F.avg("fgp").alias("_afgp"), F.avg("ftp").alias("_aftp"), *moments(raw)]
    s1 = weighted(W.with_group_stats(players, [year], first))
    carried = [c for c in s1.columns if c not in players.columns and c not in ("fg", "ft")]
    per_year = s1.groupBy(year).agg(*[F.max(c).alias(c) for c in carried], *moments(["fg", "ft"]))
    s2 = weighted(W.attach(players, per_year, [year]))
    for c in (*raw, "fg", "ft"):
        most = F.greatest(F.abs(z(F.col(f"_hi_{c}"), c)), F.abs(z(F.col(f"_lo_{c}"), c)))
        s2 = s2.withColumn(f"z{c}", -z(F.col(c), c) if c == "tov" else z(F.col(c), c)).withColumn(f"_m_z{c}", most)
    s2 = s2.withColumn("ztot", W.row_sum(scores))
    for c in scores:
        s2 = s2.withColumn(f"n{c[1:]}", W.safe_div(F.col(c), F.col(f"_m_{c}")))
    own = [c for c in s2.columns if c in players.columns or not c.startswith("_")]
    return s2.select(*own).withColumn("ntot", W.row_sum([f"n{c[1:]}" for c in scores]))


def season_deltas(scored: DataFrame, entity: str = "name", order: str = "year") -> DataFrame:
    """valueZ/valueN (total scores) and their change against the previous season."""
    x = scored.select(entity, order, "age", F.col("ztot").alias("value_z"), F.col("ntot").alias("value_n"))
    return W.delta_previous(x, entity, order, ["value_z", "value_n"], prefix="delta_") \
        .withColumnRenamed("delta_value_z", "delta_z").withColumnRenamed("delta_value_n", "delta_n")


def with_experience(df: DataFrame, entity: str = "name", age: str = "age") -> DataFrame:
    return W.offset_from_first(df, entity, age, "exp")


def exclude_first_year(df: DataFrame, entity: str = "name", year: str = "year") -> DataFrame:
    """Drop entities that have a row in the first (left-censored) year of the data."""
    first = df.agg(F.min(year)).first()[0]
    seen = df.where(F.col(year) == F.lit(first)).select(entity).distinct()
    return df.join(seen, entity, "left_anti")


def prior_pairs(scored: DataFrame, cols: Sequence[str], entity: str = "name", year: str = "year") -> DataFrame:
    """Current and previous-year values with differences (a gap year gives no pair)."""
    from stratum.operators.joins import prior_period_pairs

    p = prior_period_pairs(scored, entity, year, cols)
    for c in cols:
        p = p.withColumn(f"{c}diff", F.col(c) - F.col(f"{c}0"))
    return p


def add_next_season(df: DataFrame, entity: str = "name", year: str = "year", bump: Sequence[str] = ("age", "exp"),
                    ) -> DataFrame:
    """Rows of the last year, moved one year on with empty statistics (rows to predict), ∪ distinct."""
    last = df.agg(F.max(year)).first()[0]
    nxt = df.where(F.col(year) == F.lit(last)).select(
        *[(F.col(c) + 1).alias(c) if c in bump or c == year else
          (F.col(c) if c == entity else F.lit(None).cast(df.schema[c].dataType).alias(c)) for c in df.columns])
    return df.unionByName(nxt).distinct()


def cumulative_vectors(scored: DataFrame, entity: str = "name", order: str = "year",
                       scores: Sequence[str] = SCORES) -> DataFrame:
    """(entity, season ordinal e, year, vector of the scores of seasons 0..e).

    The running concatenation needs the entity's rows in order anyway (a
    window partitioned by entity), so the ordinal comes from the same window
    sort instead of a separate ranking pass.
    """
    from pyspark.sql import Window

    x = scored.select(entity, order, F.array(*[F.col(c) for c in scores]).alias("_line"))
    w = Window.partitionBy(entity).orderBy(order)
    hist = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    x = x.select(entity, order, (F.row_number().over(w) - 1).cast("int").alias("experience"),
                 F.flatten(F.collect_list("_line").over(hist)).alias("vec"))
    return x


def similar_within_radius(vectors: DataFrame, radius: float, entity: str = "name", level: str = "experience",
                          vec: str = "vec", hot_cell_rows: int = 32_768, classes: int = 6) -> DataFrame:
    """Ordered pairs of distinct entities at the same level with RMS distance ≤ ``radius``.

    Exact. Coordinates i fall into ``classes`` classes i mod classes (for season vectors of six scores a class is one score); the
    classes' indicators are orthogonal, so by Bessel's inequality the squared gaps of the normalised class sums, and that of the
    lengths of what the sums leave over, add up to at most RMS². Rows of a level are sorted along the direction in which their
    class sums vary most and cut into blocks of at most ``hot_cell_rows`` rows (fewer of very long vectors), each one row with its
    bounds in these directions. Blocks whose bounds are further apart than the radius never meet; of the others each unordered pair of blocks
    meets once, in a task that compares leaves of close rows with the rows near their bounds, as matrix products in single
    precision with all rounding on the side of the candidates, and decides by the exact distance (``radius.comparer``). Both
    directions of a pair are results. What is shuffled is blocks, no pair before or after it is a result; a task holds two
    blocks and the products of some rows with a leaf. The work, and possibly the result, still grows with the square of the rows.
    The radius bounds the result: pairs further apart are not reported. Vectors of different lengths, rows with an empty vector or
    a NULL, NaN or infinite value in it, and rows without a level or an entity match nothing.
    """
    from stratum.operators.radius import comparer, packer
    from stratum.session import cut_lineage

    n = F.size(vec).cast("double")

    def class_sum(j):
        size = F.floor((F.size(vec) + (classes - 1 - j)) / classes)
        total = F.aggregate(F.filter(vec, lambda x, i: i % classes == j), F.lit(0.0), lambda a, x: a + x)
        return F.when(size > 0, total / F.sqrt(size * n)).otherwise(0.0)

    sums = [f"_u{j}" for j in range(classes)]
    finite = F.size(vec).__gt__(0) & F.forall(vec, lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    base = cut_lineage(vectors.where(finite & F.col(entity).isNotNull() & F.col(level).isNotNull())
                       .select(level, entity, "year", F.xxhash64(entity).alias("_number"), vec, F.size(vec).alias("_len"),
                               *[class_sum(j).alias(u) for j, u in enumerate(sums)]))
    group = [level, "_len"]
    spread = base.groupBy(*group).agg(*[F.covar_pop(a, b).alias(f"_v{i}_{j}") for i, a in enumerate(sums) for j, b in enumerate(sums) if i <= j])
    along = spread.select(*group, F.array(*[F.col(f"_v{min(i, j)}_{max(i, j)}") for i in range(classes) for j in range(classes)]).alias("_along"))
    kind = along.schema[level].dataType.simpleString()
    along = along.mapInArrow(_widest(classes), f"{level} {kind}, _len int, _along array<double>")
    place = sum((F.col(u) * F.col("_along")[j] for j, u in enumerate(sums)), F.lit(0.0))
    placed = base.join(along, group).select(level, entity, "year", "_number", vec, "_len", place.alias("_place"))
    placed = placed.repartitionByRange(level, "_len", "_place", "_number").sortWithinPartitions(level, "_len", "_place", "_number")
    packed = placed.select(level, entity, "year", "_number", F.col(vec).cast("array<double>")).mapInArrow(
        packer(classes, hot_cell_rows), f"{level} {kind}, _len int, _lo array<double>, _hi array<double>, _rows binary")
    blocks = cut_lineage(packed.withColumn("_block", F.monotonically_increasing_id()))  # once: the numbers are kept
    parts = max(1, min(4 * blocks.count(), 20_000))  # tasks by the blocks there are, whose bytes say little of the work in them

    edges = blocks.select(level, "_len", "_block", "_lo", "_hi")
    a, b = (edges.select(level, "_len", *[F.col(c).alias(f"{c}_{s}") for c in ("_block", "_lo", "_hi")]) for s in "ab")
    gaps = F.zip_with(F.zip_with("_lo_a", "_hi_b", lambda x, y: x - y), F.zip_with("_lo_b", "_hi_a", lambda x, y: x - y), lambda x, y: F.greatest(x, y, F.lit(0.0)))
    apart = F.aggregate(gaps, F.lit(0.0), lambda t, x: t + x * x)
    reach = radius * (1 + 1e-9)  # the bound holds for real numbers: leave room for rounding
    # each unordered pair once, and about as often in one order as in the other, so that the tasks of all blocks get their share
    once = (F.col("_block_a") == F.col("_block_b")) | ((F.col("_block_a") < F.col("_block_b")) == ((F.col("_block_a") + F.col("_block_b")) % 2 == 0))
    met = a.join(b, group).where(once & (F.col("_block_a") != F.col("_block_b")) & (apart <= reach * reach) | (F.col("_block_a") == F.col("_block_b")))
    met = met.select(level, "_len", "_block_a", "_block_b")

    def side(s):
        return blocks.select(F.col("_block").alias(f"_block_{s}"), F.col("_rows").alias(f"_rows_{s}")).repartition(parts, f"_block_{s}").hint("merge")

    met = met.repartition(parts, "_block_a").join(side("a"), "_block_a")
    met = met.repartition(parts, "_block_b").join(side("b"), "_block_b")
    other = "similar_" + entity
    types = {f.name: f.dataType.simpleString() for f in base.schema}
    return met.select(level, "_len", (F.col("_block_a") == F.col("_block_b")).alias("_same"), "_rows_a", "_rows_b").mapInArrow(
        comparer(radius, classes, [level, "year", entity, other, "similarity_score"]),
        f"{level} {kind}, year {types['year']}, {entity} {types[entity]}, {other} {types[entity]}, similarity_score double")


def _widest(classes: int):
    """mapInArrow step: the leading eigenvector of each group's matrix of covariances."""
    import numpy as np
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            found = []
            for m in batch.column(2).to_pylist():
                m = np.array(m, float).reshape(classes, classes)
                found.append(np.linalg.eigh(m)[1][:, -1].tolist() if np.isfinite(m).all() else [1.0] + [0.0] * (classes - 1))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.float64()))], names=batch.schema.names)

    return run

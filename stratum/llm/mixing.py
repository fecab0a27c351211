"""Mixing sources to target weights: exact block quotas, dealt to output shards by a multivariate-hypergeometric splitting tree.

1. Targets. Every source has a weight and a size (words). The targets share the corpus' words by weight, but stop at
   ``max_epochs`` times a source's size; the excess is reshared by weight until none is above. Sorted by size over weight the
   stopped sources come first, so two running sums name them.
2. Blocks. A source's documents, in the order of a hash, form one stream of words that is cut into blocks; a document's place
   follows from sums per (source, bucket) cell and running sums inside each cell. A source gives whole epochs of all its
   blocks and, of one more, the first blocks of a seeded permutation, the last of them cut short: its words are its target,
   rounded. The permutation of block numbers is computed (swap-or-not rounds on a keyed hash), not sorted.
3. Splitting tree. The root holds all quotas; a node deals its quotas to its two halves by one multivariate-hypergeometric
   draw (the sources one after the other, each a univariate draw by ratio-of-uniforms rejection), so that the shards hold what
   a uniform shuffle of all blocks would give them, in total exactly the quotas. A node also carries the number of each
   source's draws to its left, so that the leaves own disjoint ranges of the permuted blocks.
4. Shards. Draws and pieces of documents meet on (source, draw); a shard's blocks are put into the order of a hash.

Only DataFrame functions run. All draws come from hashes of ``seed``, ids and texts, never of partitions: reruns agree.
A null text has no words; null sources are a source, the last. Documents without words are taken 0 times. Equal rows (id, text
and source) are rows of their own; they share one bucket. An empty table gives an empty mix. Very long texts are cut into
blocks like any other. Extra columns are not read. One node row holds a number for every source: sources are a list that
somebody weighs, not data that grows with the documents.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import table

#: (source, bucket) cells: fixed, so that the order of a source's stream does not depend on the cluster.
BUCKETS = 1024
ROUNDS = 24
ATTEMPTS = 96
#: ln n! below 16; above, Stirling's series is exact to double precision.
LOG_FACTORIALS = [math.lgamma(n + 1) for n in range(16)]


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+``: words, each of which begins after white space or at the start."""
    return F.regexp_count(F.coalesce(text.cast("string"), F.lit("")), F.lit("[^ \\t-\\r]+")).cast("long")


def _uniform(parts: str) -> str:
    """A number in (0, 1) from a hash: its upper 52 bits."""
    return f"((shiftrightunsigned(xxhash64({parts}), 12) + 0.5D) * {2.0 ** -52}D)"


def _log_factorial(n: str) -> str:
    x = f"cast({n} as double)"
    small = ", ".join(f"{v}D" for v in LOG_FACTORIALS)
    return (f"(CASE WHEN {n} < 16 THEN element_at(array({small}), cast({n} as int) + 1) ELSE {x} * ln({x}) - {x} + 0.5D * ln({2 * math.pi}D * {x}) "
            f"+ 1 / (12 * {x}) - 1 / (360 * power({x}, 3)) + 1 / (1260 * power({x}, 5)) END)")


def _log_mass(x: str) -> str:
    """ln of the hypergeometric mass at x, less what does not depend on x."""
    return f"(-({_log_factorial(x)} + {_log_factorial(f'(h.good - {x})')} + {_log_factorial(f'(h.n - {x})')} + {_log_factorial(f'(h.bad - h.n + {x})')}))"


def hypergeometric(good: str, bad: str, n: str, key: str) -> str:
    """SQL of one draw: how many of ``n`` items taken from ``good`` + ``bad`` are good (longs). ``key``: what the hash is taken of.

    Ratio of uniforms: a point in a rectangle around the mean that holds the region under the square root of the mass, scaled
    by its value at the mode, is accepted where it lies inside. The rectangle's scale bounds that region for every unimodal
    mass of this family; most points are accepted, so that ``ATTEMPTS`` do not run out (the mode would stand in).
    """
    once = lambda value, then: f"transform(array({value}), h -> {then})[0]"  # noqa: E731 - names a struct, so that it is computed once
    total, share = "greatest(h.good + h.bad, 1L)", "(h.good / greatest(h.good + h.bad, 1L))"
    spread = f"(h.n * {share} * (1 - {share}) * ({total} - h.n) / greatest({total} - 1, 1L))"
    width = f"({2 * math.sqrt(2 / math.e)}D * sqrt({spread} + 0.5D) + {3 - 2 * math.sqrt(3 / math.e)}D)"
    mode = f"least(h.high, greatest(h.low, cast(floor(cast(h.n + 1 as double) * (h.good + 1) / ({total} + 2)) as bigint)))"
    draw = (f"coalesce(aggregate(sequence(1, {ATTEMPTS}), cast(null as bigint), (found, i) -> CASE WHEN found IS NOT NULL THEN found ELSE "
            f"try_element_at(filter(transform(array(struct({_uniform(key + ', i')} AS u, {_uniform(key + ', -i')} AS v)), p -> struct(p.u AS u, "
            f"cast(floor(h.mid + h.width * (p.v - 0.5D) / p.u) as bigint) AS x)), p -> p.x >= h.low AND p.x <= h.high AND "
            f"2 * ln(p.u) <= {_log_mass('least(h.high, greatest(h.low, p.x))')} - h.top).x, 1) END), h.mode)")
    with_top = f"struct(h.*, {_log_mass('h.mode')} AS top)".replace("h.*", ", ".join(f"h.{c} AS {c}" for c in ("good", "bad", "n", "low", "high", "mid", "width", "mode")))
    with_mode = f"struct(h.good AS good, h.bad AS bad, h.n AS n, h.low AS low, h.high AS high, h.n * {share} + 0.5D AS mid, {width} AS width, {mode} AS mode)"
    with_ends = "struct(h.good AS good, h.bad AS bad, h.n AS n, greatest(0L, h.n - h.bad) AS low, least(h.good, h.n) AS high)"
    drawn = once(with_mode, once(with_top, draw))
    return once(f"struct({good} AS good, {bad} AS bad, {n} AS n)", once(with_ends, f"CASE WHEN h.low = h.high THEN h.low ELSE {drawn} END"))


def permuted(x: Column, n: Column, *key) -> Column:
    """A keyed bijection of 0..n-1: rounds that swap x with its mirror image around a keyed point, or do not."""
    def swap(at: Column, i: Column) -> Column:
        mirror = F.pmod(F.pmod(F.xxhash64(*key, i), n) - at + n, n)
        return F.when(F.pmod(F.xxhash64(*key, i, F.greatest(at, mirror)), F.lit(2)) == 1, mirror).otherwise(at)

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), x, swap)


def targets(sized: DataFrame, weights: tuple[float, ...] = (5, 2, 1), max_epochs: int = 3) -> DataFrame:
    """source, place (rank by code point from 0, null last), source_size, target: one row per source of rows (source, size).

    Weights repeat along the ranks. Prefix sums over the sources sorted by size over weight find the ones that stop.
    """
    s = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    s = s.withColumn("place", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), F.pmod("place", F.lit(len(weights))).cast("int") + 1)
    s = s.withColumns({"weight": w, "most": max_epochs * F.col("source_size")})
    before = Window.orderBy(F.col("most") / F.col("weight"), "place").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    s = s.withColumns({"_most": F.coalesce(F.sum("most").over(before), F.lit(0)), "_weight": F.sum("weight").over(every) - F.coalesce(
        F.sum("weight").over(before), F.lit(0.0)), "_all": F.sum("source_size").over(every)})
    s = s.withColumn("stops", F.col("most") * F.col("_weight") <= (F.col("_all") - F.col("_most")) * F.col("weight"))
    free = F.sum(F.when(F.col("stops"), 0.0).otherwise(F.col("weight"))).over(every)
    left = F.col("_all") - F.sum(F.when(F.col("stops"), F.col("most")).otherwise(0)).over(every)
    return s.select("source", "place", "source_size", F.when(F.col("stops"), F.col("most").cast("double")).otherwise(
        left * F.col("weight") / free).alias("target"))


def quotas(goal: DataFrame, block_words: int, least_blocks: int, seed: int) -> DataFrame:
    """Per source: block (words of one), blocks, epochs (whole ones), extra (blocks of one more epoch), cut (words that its last
    block lacks), quota (draws in all). The words come to the rounded target."""
    q = goal.withColumn("words", F.floor(F.col("target") + 0.5).cast("long"))
    q = q.withColumn("block", F.greatest(F.lit(1), F.least(F.lit(block_words), F.floor(F.col("source_size") / least_blocks))).cast("long"))
    size, block = F.col("source_size"), F.col("block")
    q = q.withColumns({"blocks": F.ceil(size / block).cast("long"),
                       "epochs": F.when(size > 0, F.floor(F.col("words") / F.greatest(size, F.lit(1)))).otherwise(0).cast("long")})
    q = q.withColumns({"_rest": F.col("words") - F.col("epochs") * size, "_short": F.col("blocks") * block - size})
    q = q.withColumn("extra", F.ceil(F.col("_rest") / block).cast("long"))
    last = F.when(F.col("extra") > 0, permuted(F.col("blocks") - 1, F.greatest("blocks", F.lit(1)), F.lit(seed), F.col("place"), F.col("epochs")))
    q = q.withColumn("_holds", F.coalesce(last < F.col("extra"), F.lit(False)))  # is the source's short last block among them?
    q = q.withColumn("extra", F.when(F.col("_holds"), F.ceil((F.col("_rest") + F.col("_short")) / block).cast("long")).otherwise(F.col("extra")))
    cut = F.col("extra") * block - F.when(F.col("_holds"), F.col("_short")).otherwise(0) - F.col("_rest")
    return q.select("source", "place", "source_size", "target", "block", "blocks", "epochs", "extra", cut.alias("cut"),
                    (F.col("epochs") * F.col("blocks") + F.col("extra")).alias("quota"))


def split_tree(quota: DataFrame, shard_blocks: int, seed: int) -> DataFrame:
    """Written: shard, place (of the source), first, n: the range of the source's draws that the shard owns.

    Nodes are rows (low, high: its shards; q and first: one number per source). Each level deals every node's draws to its halves.
    """
    whole = F.array_sort(F.collect_list(F.struct("place", "quota")))
    root = quota.agg(F.transform(whole, lambda x: x["quota"]).alias("q"))
    total = quota.agg(F.sum("quota")).first()[0] or 0
    shards = max(1, -(-total // shard_blocks))
    nodes = root.select(F.lit(0).cast("long").alias("low"), F.lit(shards).cast("long").alias("high"), "q",
                        F.transform("q", lambda x: F.lit(0).cast("long")).alias("first"))
    start = lambda at: F.floor(F.lit(total).cast("decimal(38,0)") * at / shards).cast("long")  # noqa: E731 - draws before shard `at`
    spread = int(quota.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    for level in range((shards - 1).bit_length()):
        half = F.floor((F.col("low") + F.col("high")) / 2).cast("long")
        nodes = nodes.withColumns({"half": half, "left_n": start(half) - start(F.col("low"))})
        drawn = hypergeometric("q[at]", "acc.rest - q[at]", "acc.n", f"{int(seed)}L, low, high, at")
        dealt = F.expr("aggregate(sequence(0, size(q) - 1), struct(left_n AS n, aggregate(q, 0L, (a, x) -> a + x) AS rest, cast(array() as array<bigint>) AS out), "
                       f"(acc, at) -> transform(array({drawn}), v -> struct(acc.n - v AS n, acc.rest - q[at] AS rest, concat(acc.out, array(v)) AS out))[0], "
                       "acc -> acc.out)")
        nodes = nodes.withColumn("left", F.when(F.col("half") > F.col("low"), dealt))
        plus = lambda a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))
        parts = F.when(F.col("half") == F.col("low"), F.array(F.struct("low", "high", "q", "first"))).otherwise(F.array(
            F.struct(F.col("low"), F.col("half").alias("high"), F.col("left").alias("q"), F.col("first")),
            F.struct(F.col("half").alias("low"), F.col("high"), F.zip_with("q", "left", lambda a, b: a - b).alias("q"),
                     F.zip_with("first", "left", plus).alias("first"))))
        nodes = nodes.select(F.explode(parts).alias("node")).select("node.*")
        if level % 4 == 3:  # spread the nodes, and keep the plan short
            nodes = table(nodes.repartition(min(spread, 1 << level), "low"), "mix-tree")
    cells = F.arrays_zip("q", "first")
    return table(nodes.select(F.col("low").alias("shard"), F.posexplode(cells).alias("place", "cell")).where("cell.q > 0").select(
        "shard", "place", F.col("cell.first").alias("first"), F.col("cell.q").alias("n")), "mix-shards")


def sizes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Written: row, doc_id, source, size, bucket, h (order in the bucket)."""
    rows = df.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), F.col(text_col).cast("string").alias("text"))
    h = F.xxhash64(F.col("doc_id").cast("string"), "text")
    rows = rows.select("doc_id", "source", word_count(F.col("text")).alias("size"), h.alias("h"))
    return table(rows.select("doc_id", "source", "size", F.monotonically_increasing_id().alias("row"),
                             F.pmod("h", F.lit(BUCKETS)).cast("int").alias("bucket"), "h"), "mix-sizes")


def mix(sized: DataFrame, goal: DataFrame, seed: int = 7, block_words: int = 1024, least_blocks: int = 256, shard_blocks: int = 4096) -> DataFrame:
    """The mix, one row per piece of a document: shard, position, row, doc_id, source, start and length (words of the document), epoch.

    ``sized`` from ``sizes``, ``goal`` from ``targets``. Positions are gapless inside a shard, in the order of its training text.
    """
    quota = table(quotas(goal, block_words, least_blocks, seed), "mix-quotas")
    shards = split_tree(quota, shard_blocks, seed)
    draws = shards.select("shard", "place", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("n") - 1)).alias("draw"))
    cells = sized.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    over = Window.partitionBy("source").orderBy("bucket")  # at most BUCKETS rows
    cells = cells.select("source", "bucket", (F.sum("words").over(over) - F.col("words")).alias("base"))
    cells = table(cells.join(quota, F.equal_null(cells["source"], quota["source"])).select(
        cells["source"], "bucket", "base", "source_size", "place", "block", "blocks", "epochs", "extra", "cut"), "mix-cells")
    run = Window.partitionBy("source", "bucket").orderBy("h", "doc_id", "size", "row").rowsBetween(Window.unboundedPreceding, 0)
    local = sized.select("*", (F.sum("size").over(run) - F.col("size")).alias("at")).where("size > 0")
    placed = local.join(cells, F.equal_null(local["source"], cells["source"]) & (local["bucket"] == cells["bucket"])).select(
        "row", "doc_id", local["source"], "size", (F.col("at") + F.col("base")).alias("at"), "source_size", "place", "block", "blocks",
        "epochs", "extra", "cut")
    pieces = placed.withColumn("number", F.explode(F.sequence(F.floor(F.col("at") / F.col("block")).cast("long"),
                                                              F.floor((F.col("at") + F.col("size") - 1) / F.col("block")).cast("long"))))
    # inside the generator, so that the permutation is computed once
    pass_of = F.transform(F.sequence(F.lit(0).cast("long"), F.col("epochs")), lambda e: F.struct(
        e.alias("epoch"), permuted(F.col("number"), F.col("blocks"), F.lit(seed), F.col("place"), e).alias("turn")))
    pieces = pieces.withColumn("_e", F.explode(pass_of)).select("*", "_e.epoch", "_e.turn").drop("_e")
    pieces = pieces.where((F.col("epoch") < F.col("epochs")) | (F.col("turn") < F.col("extra")))
    first = F.greatest("at", F.col("number") * F.col("block"))
    cut = F.when((F.col("epoch") == F.col("epochs")) & (F.col("turn") == F.col("extra") - 1), F.col("cut")).otherwise(0)
    last = F.least(F.col("at") + F.col("size"), F.least((F.col("number") + 1) * F.col("block"), "source_size") - cut)
    pieces = pieces.select("row", "doc_id", "source", "place", (F.col("epoch") * F.col("blocks") + F.col("turn")).alias("draw"), "epoch",
                           (first - F.col("at")).alias("start"), (last - first).alias("length"), "at").where("length > 0")
    dealt = pieces.join(draws.hint("merge"), ["place", "draw"])  # one row per block: not for a broadcast, whatever the estimate
    order = Window.partitionBy("shard").orderBy(F.xxhash64(F.lit(seed), "place", "draw"), "place", "draw", "at", "row")  # shard_blocks blocks
    return dealt.select("shard", (F.row_number().over(order) - 1).alias("position"), "row", "doc_id", "source", "start", "length", "epoch")


def taken(df: DataFrame, weights: tuple[float, ...] = (5, 2, 1), max_epochs: int = 3, seed: int = 7, id_col: str = "doc_id",
          text_col: str = "text", source_col: str = "source", **sizes_of) -> DataFrame:
    """Per document: doc_id, size, source_size, target (its source's), taken (its words in the mix, repeats counted)."""
    sized = sizes(df, id_col, text_col, source_col)
    goal = table(targets(sized, weights, max_epochs), "mix-targets")
    got = mix(sized, goal, seed, **sizes_of).groupBy("row").agg(F.sum("length").alias("taken"))
    rows = sized.join(got, "row", "left")
    return rows.join(goal, F.equal_null(rows["source"], goal["source"])).select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))

"""Embedding near-duplicates by collision counting over sorted one-dimensional projections.

Every vector, scaled to length one, is projected on ``PROJECTIONS`` random normal directions. Two vectors at the cosine limit
lie ``far`` apart, and each projection of their difference is normal with that deviation: a window of 2.5 deviations
around the query's projection holds the partner with probability ``p``. A pair is a candidate if it collides in at least
``needed`` windows, the largest count that a pair at the limit reaches with probability ``RECALL``; candidates are verified
by their cosine in double precision.

To spare far pairs, the first projections form ``TABLES`` groups of ``JOINT``: a vector lies in one cell of each group's grid and asks
the cells that its windows touch; within a cell the vectors are sorted by the group's first projection and the query's
window there gives the pairs to count. A pair that meets in several groups counts in the first of them only. Cells with more
than ``BLOCK`` vectors are dealt out as a grid of blocks. Links are not emitted as pairs: a block sends each vector's number of links
and a spanning forest of the block's links, so the output grows with the vectors.

Equal vectors of a label are one vector with a number. Null labels and vectors that are null, empty, zero or hold null or non-finite
components link with nothing; vectors of different lengths are never compared. A null id is counted as a partner and gets
the smallest id of its component. Empty tables give empty results; further columns are not read. Vectors of any length are
compared whole; they travel in the precision of their column.
"""

from __future__ import annotations

from itertools import product
from math import comb, erf, sqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from .common import components, table

PROJECTIONS = 24
TABLES = 3
JOINT = 3
DEVIATIONS = 2.5
RECALL = 0.999
BLOCK = 4096
#: Pairs of one window that are counted and verified at a time.
PAIRS = 1 << 17


def needed(p: float, m: int = PROJECTIONS, recall: float = RECALL) -> int:
    """The largest count that a binomial (m, p) reaches with probability ``recall``."""
    above = 0.0
    for count in range(m, -1, -1):
        above += comb(m, count) * p ** count * (1 - p) ** (m - count)
        if above >= recall:
            return count
    return 0


def directions(size: int) -> np.ndarray:
    return np.random.RandomState(20).normal(size=(size, PROJECTIONS))


def unit(raw: list[bytes], size: int) -> np.ndarray:
    """Vectors of length one in double precision, from rows of four or eight bytes a component."""
    joined = b"".join(raw)
    x = np.frombuffer(joined, "<f4" if len(joined) == 4 * size * len(raw) else "<f8").reshape(-1, size).astype(float)
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (a, b) as (node, smallest node reachable) for all nodes but the smallest of each component."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[:len(a)], at[len(a):]
    low = np.arange(len(nodes))
    while True:
        new = low.copy()
        np.minimum.at(new, x, low[y])
        np.minimum.at(new, y, low[x])
        new = new[new]
        if (new == low).all():
            break
        low = new
    far = low != np.arange(len(nodes))
    return nodes[far], nodes[low[far]]


def classes(df: DataFrame, id_col: str, vector_col: str, label_col: str) -> tuple[DataFrame, DataFrame]:
    """(rows: vec_id and its class k1, k2; classes: class number cid, label, vector, members, smallest id). Written."""
    kind = df.schema[vector_col].dataType
    kind = "float" if isinstance(kind, ArrayType) and isinstance(kind.elementType, FloatType) else "double"
    v = F.col(vector_col).cast(f"array<{kind}>")
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"), v.alias("v"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = rows.withColumn("v", F.when(F.col("label").isNotNull() & F.coalesce(fine, F.lit(False)), F.transform("v", lambda x: x + F.lit(0.0).cast(kind))))
    rows = rows.withColumns({"k1": F.when(F.col("v").isNotNull(), F.xxhash64("label", "v")),
                             "k2": F.when(F.col("v").isNotNull(), F.xxhash64(F.lit(1), "v", "label"))})
    found = (rows.where("v is not null").groupBy("k1", "k2").agg(F.min("vec_id").alias("first"), F.count("*").alias("members"),
                                                                 F.first("label").alias("label"), F.first("v").alias("v")))
    return table(rows.select("vec_id", "k1", "k2"), "vec-rows"), table(found, "vec-classes")


def near_duplicates(df: DataFrame, cosine: float = 0.98, id_col: str = "vec_id", vector_col: str = "embedding",
                    label_col: str = "label") -> DataFrame:
    """vec_id, n_links, component_id, kept for every row."""
    rows, kinds = classes(df, id_col, vector_col, label_col)
    far = sqrt(max(0.0, 2 - 2 * cosine))
    window = DEVIATIONS * far
    enough = needed(erf(DEVIATIONS / sqrt(2)))

    def touched(batches, own_only=False):
        """Of slices of vectors of one length: (their rows, size, matrix, [(group, own cell?, cell names)])."""
        for batch in (b.slice(at, 256) for b in batches for at in range(0, b.num_rows, 256)):
            lengths, values = pc.list_value_length(batch.column(4)).to_numpy(), batch.column(4).flatten().to_numpy()
            ends = np.cumsum(lengths)
            labels = batch.column(3).to_pylist()
            for size in np.unique(lengths).tolist():
                rows = np.flatnonzero(lengths == size)
                v = values[(ends[rows] - size)[:, None] + np.arange(size)]
                x = v.astype(float)
                p = (x / np.sqrt((x * x).sum(axis=1))[:, None]) @ directions_of(size)[:, :TABLES * JOINT]
                cell = np.floor(p / (2 * window)).astype(int)
                side = np.where(p - cell * 2 * window < window, -1, 1)
                found = []
                for t in range(TABLES):
                    at = slice(t * JOINT, (t + 1) * JOINT)
                    for move in ((0,) * JOINT,) if own_only else product((0, 1), repeat=JOINT):
                        places = (cell[:, at] + side[:, at] * move).tolist()
                        found.append((t, not any(move), [f"{t}:{size}:{','.join(map(str, c))}|{labels[r]}" for r, c in zip(rows.tolist(), places)]))
                yield batch.take(pa.array(rows)), size, v, found

    def own_cells(batches):
        for _, _, _, found in touched(batches, own_only=True):
            for _, _, cells in found:
                yield pa.RecordBatch.from_arrays([pa.array(cells)], names=["cell"])

    def place(batches):
        """A row per group and touched cell; ``own`` marks the cell in which the vector itself lies."""
        for part, size, v, found in touched(batches):
            n, raw = part.num_rows, pa.array([r.tobytes() for r in v], pa.binary())
            for t, own, cells in found:
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), part.column(2), pa.array(cells), pa.array(np.full(n, t, np.int32)),
                     pa.array(np.full(n, size, np.int32)), pa.array([own] * n), raw],
                    names=["k1", "k2", "members", "cell", "t", "size", "own", "raw"])

    vectors = kinds.select("k1", "k2", "members", F.col("label").cast("string").alias("label"), "v")
    crowded = table(vectors.mapInArrow(own_cells, "cell string").groupBy("cell").agg(F.count("*").alias("n")).where(F.col("n") > BLOCK)
                    .select("cell", F.ceil(F.col("n") / BLOCK).cast("int").alias("parts")), "vec-crowded")
    spots = vectors.mapInArrow(place, "k1 long, k2 long, members long, cell string, t int, size int, own boolean, raw binary")
    dealt = spots.join(crowded, "cell", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    dealt = dealt.withColumn("mine", F.pmod(F.col("k1"), F.col("parts"))).withColumn("other", F.explode(F.expr("sequence(0, parts - 1)")))
    sides = F.when(F.col("own"), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(1)))  # 0: it is looked for, 1: it asks
    dealt = dealt.withColumn("role", F.explode(sides)).select(
        F.concat_ws("/", "cell", F.when(F.col("role") == 0, F.col("mine")).otherwise(F.col("other")),
                    F.when(F.col("role") == 0, F.col("other")).otherwise(F.col("mine"))).alias("block"),
        "role", "k1", "k2", "members", "t", "size", "raw")

    def count(batches):
        """Blocks arrive whole and in order, what is looked for before what asks; only the former is held."""
        block, held, index = None, [], None
        for batch in batches:
            names = batch.column(0).to_pylist()
            role = batch.column(1).to_numpy()
            cuts = [0, *(i for i in range(1, len(names)) if names[i] != names[i - 1] or role[i] != role[i - 1]), len(names)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if names[a] != block:
                    block, held, index = names[a], [], None
                part = batch.slice(a, b - a)
                if role[a] == 0:
                    held.append(part)
                    continue
                if not held:
                    continue
                index = index or _Index(held)
                for at in range(0, part.num_rows, 512):
                    yield from index.ask(part.slice(at, 512), window, enough, cosine)

    links = table(dealt.repartition("block").sortWithinPartitions("block", "role").mapInArrow(
        count, "k1 long, k2 long, n long, r1 long, r2 long"), "vec-links")
    # class numbers: the smallest id names a class (a null id sorts last); ties by the hashes
    numbered = table(kinds.select("k1", "k2", "members", "first", F.xxhash64("k1", "k2").alias("cid")), "vec-numbers")
    totals = links.where("n > 0").groupBy("k1", "k2").agg(F.sum("n").alias("n"))
    edges = links.where("r1 is not null").select(F.xxhash64("k1", "k2").alias("a"), F.xxhash64("r1", "r2").alias("b"))
    roots = table(components(edges, "a", "b"), "vec-roots")
    named = table(numbered.join(totals, ["k1", "k2"], "left").join(roots, numbered["cid"] == roots["node"], "left")
                  .select("k1", "k2", "members", "first", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("root", "cid").alias("root")), "vec-named")
    lowest = table(named.groupBy("root").agg(F.min("first").alias("component_id")), "vec-lowest")
    done = table(named.join(lowest, "root").select("k1", "k2", (F.col("n") + F.col("members") - 1).alias("n_links"), "component_id"), "vec-done")
    alone = rows.where("k1 is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    found = rows.where("k1 is not null").join(done, ["k1", "k2"]).select("vec_id", "n_links", "component_id")
    return found.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


_directions: dict[int, np.ndarray] = {}


def directions_of(size: int) -> np.ndarray:
    if size not in _directions:
        _directions[size] = directions(size)
    return _directions[size]


class _Index:
    """The vectors of a block, sorted by the first projection of its group."""

    def __init__(self, held):
        self.t, size = held[0].column(5)[0].as_py(), held[0].column(6)[0].as_py()
        raw = [x for h in held for x in h.column(7).to_pylist()]
        k1, k2, members = (np.concatenate([h.column(k).to_numpy() for h in held]) for k in (2, 3, 4))
        x = unit(raw, size)
        p = x @ directions_of(size)
        order = np.argsort(p[:, self.t * JOINT], kind="stable")
        self.size, self.x, self.p = size, x[order], p[order]
        self.k1, self.k2, self.members = k1[order], k2[order], members[order]

    def ask(self, part, window: float, enough: int, cosine: float):
        """(k1, k2, n, null, null): links of each asking vector here; (k1, k2, 0, r1, r2): the links' spanning forest."""
        x = unit(part.column(7).to_pylist(), self.size)
        p, k1, k2 = x @ directions_of(self.size), part.column(2).to_numpy(), part.column(3).to_numpy()
        lead = self.p[:, self.t * JOINT]
        low = np.searchsorted(lead, p[:, self.t * JOINT] - window, "left")
        high = np.searchsorted(lead, p[:, self.t * JOINT] + window, "right")
        ends, first, found = np.cumsum(high - low), 0, []
        while first < len(p):  # about PAIRS window collisions at a time, so that a dense block needs no more memory
            stop = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + PAIRS, "right")))
            found.append(self._linked(np.arange(first, stop), low, high, x, p, k1, k2, window, enough, cosine))
            first = stop
        q, d = (np.concatenate(side) for side in zip(*found)) if found else (np.zeros(0, int),) * 2
        if not len(q):
            return
        n = np.bincount(q, weights=self.members[d], minlength=len(p)).astype(np.int64)
        at = np.flatnonzero(n)
        none = pa.nulls(len(at), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(k1[at]), pa.array(k2[at]), pa.array(n[at]), none, none], names=["k1", "k2", "n", "r1", "r2"])
        pairs = np.concatenate([np.stack([k1, k2], 1), np.stack([self.k1, self.k2], 1)])
        _, number_of = np.unique(pairs, axis=0, return_inverse=True)
        where = np.zeros(number_of.max() + 1, np.int64)
        where[number_of] = np.arange(len(pairs))
        node, root = forest(number_of[q], number_of[len(p) + d])
        node, root = where[node], where[root]
        yield pa.RecordBatch.from_arrays([pa.array(pairs[node, 0].copy()), pa.array(pairs[node, 1].copy()), pa.array(np.zeros(len(node), np.int64)),
                                          pa.array(pairs[root, 0].copy()), pa.array(pairs[root, 1].copy())], names=["k1", "k2", "n", "r1", "r2"])

    def _linked(self, asks, low, high, x, p, k1, k2, window: float, enough: int, cosine: float):
        """(query, vector here) of the pairs that collide often enough and reach the cosine."""
        number = high[asks] - low[asks]
        q = np.repeat(asks, number)
        d = np.arange(number.sum()) - np.repeat(np.cumsum(number) - number - low[asks], number)
        for j in range(self.t * JOINT + 1, (self.t + 1) * JOINT):
            near = np.abs(p[q, j] - self.p[d, j]) <= window
            q, d = q[near], d[near]
        keep = (k1[q] != self.k1[d]) | (k2[q] != self.k2[d])
        q, d = q[keep], d[keep]
        hits = np.abs(p[q] - self.p[d]) <= window
        fresh = hits.sum(axis=1) >= enough
        for t in range(self.t):  # met in an earlier group already
            fresh &= ~hits[:, t * JOINT:(t + 1) * JOINT].all(axis=1)
        q, d = q[fresh], d[fresh]
        linked = (x[q] * self.x[d]).sum(axis=1) >= cosine
        return q[linked], d[linked]

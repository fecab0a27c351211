"""Principal components of a long (row, column, value) matrix: block Lanczos to a residual bound, or subspace iteration.

Scale design: the matrix is never densified and no rows×rows or cols×cols
Gram matrix is formed. Each iteration is two join + aggregate passes over the
long table (``W = XᵀV`` by column, ``U = XW`` by row) with the k-column basis
in long form; orthonormalisation uses only the k×k Gram ``UᵀU`` (Cholesky QR),
and a final Rayleigh–Ritz step on ``WᵀW`` (k×k) gives singular values and
rotates the basis. The basis is checkpointed (reliable, shared folder) each
iteration, so lineage stays short and a lost executor recomputes one step.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.operators.joins import lookup_join
from stratum.session import cut_lineage


def _small_matrix(df: DataFrame, k: int) -> np.ndarray:
    """(c, c2, v) long k×k table → numpy (bounded: k² rows)."""
    m = np.zeros((k, k))
    for r in df.collect():
        m[int(r[0]), int(r[1])] = float(r[2])
    return m


def _apply_small(u: DataFrame, row: str, mat: np.ndarray) -> DataFrame:
    """(row, c, v) · mat → (row, c, v): right-multiply a long basis by a small k×k2 matrix."""
    spark = u.sparkSession
    k, k2 = mat.shape
    m = spark.createDataFrame([(i, j, float(mat[i, j])) for i in range(k) for j in range(k2)],
                              "c int, c2 int, m double")
    j = u.join(F.broadcast(m), "c")
    return j.groupBy(row, F.col("c2").alias("c")).agg(F.sum(F.col("v") * F.col("m")).alias("v"))


def _gram(u: DataFrame, key: str, k: int) -> np.ndarray:
    a = u.select(key, F.col("c").alias("c1"), F.col("v").alias("v1"))
    b = u.select(key, F.col("c").alias("c2"), F.col("v").alias("v2"))
    g = a.join(b, key).groupBy("c1", "c2").agg(F.sum(F.col("v1") * F.col("v2")))
    return _small_matrix(g, k)


def subspace_pca(x: DataFrame, row: str, col: str, value: str, k: int = 10, oversample: int = 5, iters: int = 30,
                 seed: int = 42, tol: float = 1e-12) -> tuple[DataFrame, list[float]]:
    """Top-``k`` left singular vectors of X (rows × cols, long form) scaled by singular values.

    Returns ((row, pc, score, converged), eigenvalues λ = σ²). Signs are fixed
    so each component's largest-magnitude score is positive. Iteration stops
    early once the top-k spectrum of the k×k Gram changes by less than ``tol``
    (relative); ``converged`` says for which components the last step did.
    """
    spark = x.sparkSession
    kk = k + oversample
    z = cut_lineage(x.select(F.col(row).alias("_r"), F.col(col).alias("_c"), F.col(value).cast("double").alias("_z"))
                    .where(F.col("_z") != 0))
    rows = z.select("_r").distinct()
    # deterministic start: hash-based uniform values per (row, component)
    # k start columns per row: explode a fixed-length sequence (no join)
    v = rows.select("_r", F.explode(F.sequence(F.lit(0), F.lit(kk - 1))).alias("c"))
    v = v.select("_r", "c", ((F.xxhash64("_r", "c", F.lit(seed)) % 100003) / 100003.0 - 0.5).alias("v"))
    v = cut_lineage(v)

    def xt(vv):  # W = Xᵀ V : (col, c, v)
        j = lookup_join(z, vv, "_r")
        return j.groupBy("_c", "c").agg(F.sum(F.col("_z") * F.col("v")).alias("v"))

    def xw(ww):  # U = X W : (row, c, v)
        j = z.join(ww, "_c")
        return j.groupBy("_r", "c").agg(F.sum(F.col("_z") * F.col("v")).alias("v"))

    prev, settled = None, np.zeros(k, bool)
    for _ in range(iters):
        u = cut_lineage(xw(xt(v)))
        g = _gram(u, "_r", kk)
        spec = np.sort(np.linalg.eigvalsh(g))[::-1][:k]
        if prev is not None:
            settled = np.abs(spec - prev) / np.maximum(np.abs(spec), 1e-300) < tol
        if settled.all():
            r = np.linalg.cholesky(g + 1e-12 * np.trace(g) * np.eye(kk)).T
            v = cut_lineage(_apply_small(u, "_r", np.linalg.inv(r)))
            break
        prev = spec
        r = np.linalg.cholesky(g + 1e-12 * np.trace(g) * np.eye(kk)).T
        v = cut_lineage(_apply_small(u, "_r", np.linalg.inv(r)))
    w = cut_lineage(xt(v))
    b = _gram(w, "_c", kk)
    lam, q = np.linalg.eigh(b)
    order = np.argsort(lam)[::-1][:k]
    lam, q = lam[order], q[:, order]
    scores = _apply_small(v, "_r", q @ np.diag(np.sqrt(np.maximum(lam, 0))))
    # sign convention: largest |score| positive per component
    top = scores.groupBy("c").agg(F.max_by("v", F.abs("v")).alias("_t"))
    scores = scores.join(F.broadcast(top), "c").select(
        F.col("_r").alias(row), F.col("c").alias("pc"), F.when(F.col("_t") < 0, -F.col("v")).otherwise(F.col("v"))
        .alias("score"), F.col("c").isin([i for i in range(k) if settled[i]]).alias("converged"))
    return scores, [float(x) for x in lam]


def _products(df: DataFrame, left: str, right: str) -> np.ndarray:
    """Sum over rows of the outer products of two list columns: partial sums per Arrow batch, added per cell by Spark."""
    def run(batches):
        total = None
        for batch in batches:
            if batch.num_rows:
                a, b = (c.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1) for c in batch.columns)
                total = a.T @ b if total is None else total + a.T @ b
        if total is not None:
            i, j = np.indices(total.shape)
            yield pa.RecordBatch.from_arrays([pa.array(i.ravel()), pa.array(j.ravel()), pa.array(total.ravel())], names=["i", "j", "v"])

    cells = df.select(left, right).mapInArrow(run, "i long, j long, v double").groupBy("i", "j").agg(F.sum("v")).collect()
    out = np.zeros((max(r[0] for r in cells) + 1, max(r[1] for r in cells) + 1))
    for i, j, v in cells:
        out[i, j] = v
    return out


def _map_lists(df: DataFrame, columns: dict, key: str = "_r") -> DataFrame:
    """key and new list columns: name -> function of a dict of matrices (one per list column of ``df``)."""
    names = [c for c in df.columns if c != key]

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                at = {n: batch.column(batch.schema.get_field_index(n)).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1) for n in names}
                made = [pa.array(list(f(at)), pa.list_(pa.float64())) for f in columns.values()]
                yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index(key)), *made], names=[key, *columns])

    kind = df.schema[key].dataType.simpleString()
    return df.mapInArrow(run, f"{key} {kind}, " + ", ".join(f"{n} array<double>" for n in columns))


#: Numbers in the lists of one Lanczos step up to which they are broadcast (8 MB).
FEW_NUMBERS = 1_000_000


def lanczos_pca(x: DataFrame, row: str, col: str, value: str, k: int = 10, block: int | None = None, tol: float = 1e-9,
                most: int = 400, seed: int = 42) -> tuple[DataFrame, list[float]]:
    """Top-``k`` left singular vectors of X (rows x cols, long form) scaled by singular values, to a residual bound.

    Block Lanczos on the smaller of A = X X' and A = X'X, which have the same eigenvalues: with v a unit vector of X'X the
    scores are X v. There is one list of basis entries per row of A, each step is two join + aggregate passes over the long
    table (kept placed by both keys, so that only lists move; where the lists of a step are few, they are broadcast and one
    placement serves both passes) and full re-orthogonalisation against the basis. On the driver
    there are only basis x block products. The residual |A u - l u| of every component follows from the last block's
    coupling; steps go on until all are below ``tol`` times the largest eigenvalue, or the space is exhausted, whose vectors
    are exact. Beyond ``most`` basis vectors the basis is restarted from its best vectors. There is no cap on the steps.

    Returns ((row, pc, score), eigenvalues). The largest score of a component is positive; components beyond the rank of X
    are absent. An empty table gives an empty result.
    """
    z = x.select(F.col(row).alias("_r"), F.col(col).alias("_c"), F.col(value).cast("double").alias("_z")).where("_z <> 0")
    placed = cut_lineage(z.repartition("_r"))
    n_rows, n_cols = (placed.select(c).distinct().count() for c in ("_r", "_c"))
    turned = n_cols < n_rows
    if turned:  # from here on _r is the column and _c the row of X
        by_col = placed.select(F.col("_c").alias("_r"), F.col("_r").alias("_c"), "_z")
    else:
        by_col = cut_lineage(placed.repartition("_c"))
    b = block or 2 * k + 4
    few = min(n_rows, n_cols) * b <= FEW_NUMBERS
    by_row = by_col if few else cut_lineage(by_col.repartition("_r")) if turned else placed

    def one(side, lists, at, to, name, width):
        sums = F.array(*[F.sum(F.col("_z") * F.col(name)[i]) for i in range(width)])
        return side.join(lists, at).groupBy(to).agg(sums.alias(name))

    def near(q: DataFrame) -> DataFrame:
        return F.broadcast(q) if few else q

    def times(q: DataFrame, name: str, width: int) -> DataFrame:  # A q
        return one(by_col, one(by_row, near(q), "_r", "_c", name, width), "_c", "_r", name, width)

    def orthonormal(s: np.ndarray, scale: float) -> tuple[np.ndarray, np.ndarray]:
        """(m, c) with u m orthonormal and u = (u m) c, for u'u = s; directions of no length are left out."""
        lam, e = np.linalg.eigh((s + s.T) / 2)
        keep = lam > max(lam.max(initial=0.0) * 1e-20, scale * scale * 1e-22, 1e-300)
        root = np.sqrt(lam[keep])
        return e[:, keep] / root, (e[:, keep] * root).T

    start = F.transform(F.sequence(F.lit(0), F.lit(b - 1)), lambda i: (F.xxhash64("_r", i, F.lit(seed)) % 100003) / 100003.0 - 0.5)
    v = cut_lineage(by_row.select("_r").distinct().select("_r", start.alias("v")))
    if v.limit(1).count() == 0:
        return x.sparkSession.createDataFrame([], x.select(row).schema.add("pc", "integer").add("score", "double")), []
    m, _ = orthonormal(_products(v, "v", "v"), 0.0)
    if m.shape[1] < b:  # fewer rows than the block
        b = m.shape[1]
    basis = cut_lineage(_map_lists(v, {"q": lambda at, m=m: at["v"] @ m}))
    small = np.zeros((0, 0))  # Q' A Q of the columns done
    width = b
    while True:
        done = small.shape[0]
        cols = slice(done, done + width)
        u = times(basis.select("_r", F.slice("q", done + 1, width).alias("u")), "u", width)
        both = cut_lineage(basis.join(u, "_r", "left").select("_r", "q", F.coalesce("u", F.array_repeat(F.lit(0.0), width)).alias("u")))
        h = _products(both, "q", "u")
        both = cut_lineage(_map_lists(both, {"q": lambda at: at["q"], "u": lambda at, h=h: at["u"] - at["q"] @ h}))
        again = _products(_map_lists(both, {"w": lambda at: np.hstack([at["q"], at["u"]]), "u": lambda at: at["u"]}), "w", "u")
        more, s = again[:done + width], again[done + width:]
        h = h + more
        grown = np.zeros((done + width, done + width))
        grown[:done, :done] = small
        grown[:, cols] = h
        grown[cols, :] = h.T
        small = (grown + grown.T) / 2
        theta, y = np.linalg.eigh(small)
        order = np.argsort(theta)[::-1]
        theta, y = theta[order], y[:, order]
        m, coupling = orthonormal(s - more.T @ more, theta[0])
        left = np.linalg.norm(coupling @ y[cols, :k], axis=0) if m.shape[1] else np.zeros(min(k, len(theta)))
        if turned:  # the residual of X v is at most sigma_1 / sigma times that of v
            left = left * np.sqrt(theta[0] / np.where(theta[:k] > tol * theta[0], theta[:k], theta[0]))
        if not m.shape[1] or (len(theta) >= k and (left <= tol * theta[0]).all()):
            break
        keep = lambda at, m=m, more=more: (at["u"] - at["q"] @ more) @ m
        if small.shape[0] + m.shape[1] > most:
            best = y[:, :2 * k + b]
            basis = cut_lineage(_map_lists(both, {"q": lambda at, best=best, keep=keep: np.hstack([at["q"] @ best, keep(at)])}))
            small = np.diag(theta[:best.shape[1]])
        else:
            basis = cut_lineage(_map_lists(both, {"q": lambda at, keep=keep: np.hstack([at["q"], keep(at)])}))
        width = m.shape[1]
    real = theta[:k] > tol * theta[0]
    theta, y = theta[:k][real], y[:, :k][:, real]
    scale = np.ones(len(theta)) if turned else np.sqrt(theta)
    scores = _map_lists(both.select("_r", "q"), {"s": lambda at: at["q"] @ (y * scale)})
    if turned:
        scores = one(by_row, near(scores), "_r", "_c", "s", len(theta)).select(F.col("_c").alias("_r"), F.when(
            F.col("_c").isNotNull(), F.col("s")).otherwise(F.array_repeat(F.lit(0.0), len(theta))).alias("s"))
    scores = cut_lineage(scores.select("_r", F.posexplode("s").alias("pc", "v")))
    top = scores.groupBy("pc").agg(F.max_by("v", F.abs("v")).alias("_t"))
    return scores.join(top, "pc").select(F.col("_r").alias(row), "pc", (F.col("v") * F.sign("_t")).alias("score")), [float(t) for t in theta]


def eigen_residuals(x: DataFrame, scores: DataFrame, row: str, col: str, value: str) -> DataFrame:
    """pc, eigenvalue (sum of squared scores) and residual |X X' u - l u| / l of the unit vectors behind the scores."""
    z = x.select(F.col(row).alias("_r"), F.col(col).alias("_c"), F.col(value).cast("double").alias("_z")).where("_z <> 0")
    s = scores.select(F.col(row).alias("_r"), "pc", "score")
    w = z.join(s, "_r").groupBy("_c", "pc").agg(F.sum(F.col("_z") * F.col("score")).alias("w"))
    u = z.join(w, "_c").groupBy("_r", "pc").agg(F.sum(F.col("_z") * F.col("w")).alias("u"))
    size = s.groupBy("pc").agg(F.sum(F.col("score") * F.col("score")).alias("eigenvalue"))
    off = F.col("u") - F.col("eigenvalue") * F.col("score")
    return s.join(u, ["_r", "pc"]).join(size, "pc").groupBy("pc", "eigenvalue").agg(F.sqrt(F.sum(off * off)).alias("_o")).select(
        "pc", "eigenvalue", (F.col("_o") / F.pow("eigenvalue", 1.5)).alias("residual"))


def standardized_genotypes(df: DataFrame) -> DataFrame:
    """(variant, sample, z): gt centred by 2p and scaled by √(2p(1−p)); missing calls → 0; monomorphic dropped."""
    af = df.groupBy("variant_id").agg((F.sum("gt") / (2 * F.count("gt"))).alias("_p"))
    af = af.where((F.col("_p") > 0) & (F.col("_p") < 1))
    j = lookup_join(df, af, "variant_id")
    zc = (F.col("gt") - 2 * F.col("_p")) / F.sqrt(2 * F.col("_p") * (1 - F.col("_p")))
    return j.select("variant_id", "sample_id", F.coalesce(zc, F.lit(0.0)).alias("z"))

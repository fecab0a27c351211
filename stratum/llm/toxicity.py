"""Toxicity as ordinal regression: cumulative links over sparse text features, one weight vector for all thresholds.

P(grade > k) = sigmoid(score - threshold_k) with thresholds in order; the score is a sum of weights of the words and word
beginnings (three to eight letters) that occur in the text, and of those that occur twice or more. The output is the expected
grade (severity) and the verdict. The severity from which a text is toxic is the one that finds most toxic texts when either
half of the sample is judged by a model of the other half, at no more than ``MAX_FALSE`` of its clean texts.

Where labels only say toxic or not (0 / 1), the grades are 0 (not toxic), 1 and 2 (toxic, with fewer than / at least the
median number of different features that are typical of toxic texts).

The model is fitted on a bounded sample of labelled rows: at most ``per_class`` rows of each label, those whose ids have the
smallest hashes. Everything else sees all rows. Null and empty texts have no features and are judged by the thresholds
alone; labels without a document or with a null label are not used, repeated labels of an id count once (the highest);
without labels of both kinds nothing is toxic. Further columns pass through or are not read.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_text, table

PER_CLASS = 3000
MAX_FEATURES = 1500
#: A text is toxic from this severity on, where the halves of the sample find no toxic text of each other.
LIMIT = 0.15
#: Severities tried on the halves, and the share of clean texts that may be taken for toxic there.
LIMITS = (0.02, 0.05, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5)
MAX_FALSE = 0.01
#: Features are left out whose shares in toxic and clean texts differ by a smaller factor, or by less than the largest of so many
#: chance differences would reach: the square root of 2 ln(number of features), against the signed root of the likelihood ratio
#: (a difference in standard errors, also for the few texts of a small language, where a normal one stays below the bound).
MIN_LIFT = 3.0
RIDGE = 1e-4
WORD = re.compile(r"[^\W\d_]+")
STEMS = range(3, 9)


def _counted(words: Counter) -> set[str]:
    found: Counter = Counter()
    for w, n in words.items():
        found[w] += n
        for k in STEMS:
            if len(w) <= k:
                break
            found[w[:k] + "*"] += n
    return found.keys() | {f + "2" for f, n in found.items() if n > 1}


def features(text: str | None) -> set[str]:
    """Lower-case words, beginnings of longer ones with a star, and either with a 2 if the text has it more than once."""
    return _counted(Counter(WORD.findall((text or "").lower())))


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def mark(text: str | None) -> int:
    """The smallest hash of the text's five-word shingles: near copies mostly share it, other texts do not."""
    import xxhash

    words = (text or "").lower().split()
    shingles = zip(*(words[k:] for k in range(5))) if len(words) >= 5 else [words]
    return min(xxhash.xxh64_intdigest(" ".join(s)) for s in shingles) >> 1


class Ordinal:
    """Weights by feature, and thresholds in rising order."""

    def __init__(self, weights: dict[str, float], thresholds: list[float], limit: float = LIMIT):
        self.weights, self.thresholds, self.limit = weights, thresholds, limit
        self.heads = {f.rstrip("*2")[:STEMS[0]] for f in weights}

    def score(self, text: str | None) -> float:
        words = Counter(w for w in WORD.findall((text or "").lower()) if w[:STEMS[0]] in self.heads)  # others have no weight
        return sum(self.weights[f] for f in sorted(self.weights.keys() & _counted(words)))

    def expected(self, scores: np.ndarray) -> np.ndarray:
        """The expected grade: the sum over thresholds of the chance to lie above."""
        return sum((_sigmoid(scores - t) for t in self.thresholds), np.zeros(len(scores)))


def train(x: np.ndarray, y: np.ndarray, grades: int, ridge: float = 1e-6, rounds: int = 600, rate: float = 0.05):
    """Maximum likelihood of the cumulative-link model with a ridge on the weights, by Adam. x: rows by features."""
    w, raw = np.zeros(x.shape[1]), np.concatenate([[1.0], np.full(grades - 2, 0.5)])  # thresholds: first, then log steps
    moments = [np.zeros(len(w) + len(raw)) for _ in range(2)]
    for step in range(1, rounds + 1):
        t = np.cumsum(np.concatenate([raw[:1], np.exp(raw[1:])]))
        s = (x @ w.astype(np.float32)).astype(float)
        up, low = np.append(t, np.inf)[y], np.append(-np.inf, t)[y]
        a, b = np.where(np.isinf(up), 1.0, _sigmoid(up - s)), np.where(np.isinf(low), 0.0, _sigmoid(low - s))
        p = np.maximum(a - b, 1e-9)
        da, db = a * (1 - a) / p, b * (1 - b) / p  # of log p by the upper and the lower threshold
        gs = (da - db) / len(y)
        gt = np.zeros(grades - 1)
        for k in range(grades - 1):
            gt[k] = (db[y == k + 1].sum() - da[y == k].sum()) / len(y)
        tail = np.cumsum(gt[::-1])[::-1]
        grad = np.concatenate([gs.astype(np.float32) @ x + ridge * w, tail[:1], tail[1:] * np.exp(raw[1:])])
        moments[0] = 0.9 * moments[0] + 0.1 * grad
        moments[1] = 0.99 * moments[1] + 0.01 * grad ** 2
        move = rate * (moments[0] / (1 - 0.9 ** step)) / (np.sqrt(moments[1] / (1 - 0.99 ** step)) + 1e-8)
        w, raw = w - move[:len(w)], raw - move[len(w):]
    return w, np.cumsum(np.concatenate([raw[:1], np.exp(raw[1:])]))


def _typical(each: DataFrame, size: dict, halves: tuple, max_features: int) -> list:
    """(f, z, lift) of the features typical of toxic or clean texts among the rows of ``halves``, the largest |z| first."""
    nt = sum(n for (half, toxic), n in size.items() if half in halves and toxic)
    nc = sum(n for (half, toxic), n in size.items() if half in halves and not toxic)
    if not nt or not nc:
        return []
    t, c = (sum((F.col(f"{k}{h}") for h in halves[1:]), F.col(f"{k}{halves[0]}")) for k in "tc")
    own = each.select("f", t.cast("double").alias("t"), c.cast("double").alias("c")).where("t + c >= 5")
    t, c = F.col("t"), F.col("c")
    share = (t + c) / (nt + nc)

    def part(x, expected):
        return F.when(x > 0, x * F.log(x / expected)).otherwise(0.0)

    ratio = 2 * (part(t, nt * share) + part(nt - t, nt * (1 - share)) + part(c, nc * share) + part(nc - c, nc * (1 - share)))
    own = own.select("f", (F.signum(t / nt - c / nc) * F.sqrt(F.greatest(ratio, F.lit(0.0)))).alias("z"),
                     (((t + 0.5) / (nt + 1)) / ((c + 0.5) / (nc + 1))).alias("lift"))
    least = float(np.sqrt(2 * np.log(max(2, own.count()))))
    return (own.where((F.abs("z") > least) & ((F.col("lift") > MIN_LIFT) | (F.col("lift") < 1 / MIN_LIFT)))
            .orderBy(F.round(F.abs("z"), 9).desc(), "f").limit(max_features).collect())


def _learn(chosen: list, rows: list, place: dict, binary: bool) -> Ordinal:
    """The model of the rows (y, half, numbers of the features found) on the chosen features."""
    if not chosen or not rows:
        return Ordinal({}, [40.0])
    names = [r.f for r in chosen]
    at = {place[f]: i for i, f in enumerate(names)}
    x, y = np.zeros((len(rows), len(names)), np.float32), np.array([r.y for r in rows])
    for i, r in enumerate(rows):
        x[i, [at[f] for f in r.found if f in at]] = 1
    order = np.lexsort(np.vstack([x.T, y]))  # the same sums whatever order the rows came in
    x, y = x[order], y[order]
    if binary:
        strong = [i for i, r in enumerate(chosen) if r.z > 3 and r.lift > 20]
        number = x[:, strong].sum(axis=1)
        middle = np.median(number[y > 0]) if (y > 0).any() else 0
        y = np.where(y == 0, 0, 1 + (number >= max(middle, 1)).astype(int))
    codes = np.unique(y)
    if len(codes) < 2:
        return Ordinal({}, [40.0])
    w, thresholds = train(x, np.searchsorted(codes, y), len(codes), RIDGE)
    return Ordinal({f: float(v) for f, v in zip(names, w)}, [float(t) for t in thresholds])


def _limit(models: list[Ordinal], rows: list, names: list[str]) -> float:
    """The limit that finds most toxic rows of each half by the model of the other; the highest such, so that few are clean."""
    severity = []
    for r in rows:
        weights = models[1 - r.half].weights
        severity.append(models[1 - r.half].expected(np.array([sum(weights.get(names[f], 0.0) for f in sorted(r.found))]))[0])
    severity, toxic = np.array(severity), np.array([r.y > 0 for r in rows])
    tried = [((severity[toxic] >= k).mean(), k) for k in LIMITS if (severity[~toxic] >= k).mean() <= MAX_FALSE]
    if not tried:
        return max(LIMITS)
    best = max(tried)
    return best[1] if best[0] > 0 else LIMIT


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", per_class: int = PER_CLASS, max_features: int = MAX_FEATURES,
        id_col: str = "doc_id", text_col: str = "text") -> Ordinal:
    """Fit on the bounded sample. ``label_col`` holds grades 0, 1, ... ; with 0 and 1 only, grades are made as said above."""
    marks = (labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("y")).where("doc_id is not null and y >= 0")
             .groupBy("doc_id").agg(F.max("y").alias("y")))
    kinds = sorted(r.y for r in marks.select("y").distinct().limit(100).collect())
    if len(kinds) < 2:
        return Ordinal({}, [40.0])
    sample = None
    for y in kinds:
        some = marks.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        sample = some if sample is None else sample.unionByName(some)
    sample = table(sample, "toxicity-sample")  # at most per_class rows of each label: the bound of the broadcast
    sampled = id_text(docs, id_col, text_col).join(F.broadcast(sample), "doc_id")

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                texts = part.column(1).to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), pa.array([mark(x) for x in texts], pa.int64()),
                     pa.array([sorted(features(x)) for x in texts], pa.list_(pa.string()))], names=["id", "y", "mark", "found"])

    id_type = sampled.schema["doc_id"].dataType.simpleString()
    seen = sampled.select("doc_id", "text", "y").mapInArrow(run, f"id {id_type}, y int, mark long, found array<string>")
    # one of a group of near copies speaks for them, else their chance words would pass for typical ones; they share a half
    seen = table(seen.groupBy("mark", "y").agg(F.min_by("found", "id").alias("found"))
                 .select("y", (F.xxhash64("mark").bitwiseAND(F.lit(1).cast("long"))).cast("int").alias("half"), "found"), "toxicity-features")
    size = {(r.half, r.toxic): r["count"] for r in seen.groupBy("half", (F.col("y") > 0).alias("toxic")).count().collect()}
    each = (seen.select("half", (F.col("y") > 0).alias("toxic"), F.explode("found").alias("f")).groupBy("f")
            .agg(*[F.count(F.when((F.col("half") == h) & (F.col("toxic") == (k == "t")), 1)).alias(f"{k}{h}") for k in "tc" for h in (0, 1)])
            .where("t0 + t1 + c0 + c1 >= 5"))
    each = table(each, "toxicity-words")
    chosen = [_typical(each, size, halves, max_features) for halves in ((0,), (1,), (0, 1))]
    if not chosen[-1]:
        return Ordinal({}, [40.0])
    names = sorted({r.f for some in chosen for r in some})
    place = {f: i for i, f in enumerate(names)}

    def number(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                found = [[place[f] for f in fs if f in place] for fs in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(found, pa.list_(pa.int32()))], names=["y", "half", "found"])

    rows = seen.mapInArrow(number, "y int, half int, found array<int>").collect()
    binary = set(kinds) <= {0, 1}
    models = [_learn(chosen[h], [r for r in rows if r.half == h], place, binary) for h in (0, 1)]
    model = _learn(chosen[2], rows, place, binary)
    model.limit = _limit(models, rows, names)
    return model


def score(df: DataFrame, model: Ordinal, id_col: str = "doc_id", text_col: str = "text", limit: float | None = None) -> DataFrame:
    """doc_id, severity (expected grade), grade (rounded), toxic (severity >= ``limit``, the model's if none is given), kept (not toxic)."""
    docs, limit = id_text(df, id_col, text_col), model.limit if limit is None else limit

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                expected = model.expected(np.array([model.score(x) for x in part.column(1).to_pylist()]))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(expected)], names=["doc_id", "severity"])

    scored = docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, severity double")
    return scored.select("doc_id", "severity", F.round("severity").cast("int").alias("grade"), (F.col("severity") >= limit).alias("toxic"),
                         (F.col("severity") < limit).alias("kept"))


def keep_clean(df: DataFrame, model: Ordinal, text_col: str = "text", limit: float | None = None) -> DataFrame:
    """The rows of ``df``, all columns, whose severity is below ``limit`` (the model's if none is given)."""
    at, limit = df.columns.index(text_col), model.limit if limit is None else limit

    def run(batches):
        for batch in batches:
            expected = model.expected(np.array([model.score(x) for x in batch.column(at).to_pylist()]))
            yield batch.filter(pa.array(expected < limit))

    return df.mapInArrow(run, df.schema)

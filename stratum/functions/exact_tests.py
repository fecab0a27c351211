"""Exact tests on small tables of counts as column expressions: a fold over the tables with the same margins.

The fold starts at the observed table, whose probability counts as 1, and walks to either end by the ratio of neighbouring
probabilities, so nothing but two sums is kept: all probabilities, and those no larger than the observed one. Where the
observed table is so unlikely that the sum overflows, the p-value is 0.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Probabilities equal to the observed one up to rounding count as equal.
EQUAL = 1 + 1e-7


def _walk(start: Column, steps: Column, ratio: Callable[[Column], Column], move: int) -> Column:
    """(all, no larger) over the tables reached from ``start`` in ``steps`` moves; ``ratio``(k) = P(k + move) / P(k)."""
    begin = F.struct(F.lit(1.0).alias("p"), F.lit(0.0).alias("every"), F.lit(0.0).alias("small"))

    def one(acc: Column, i: Column) -> Column:
        p = acc["p"] * ratio((start + (i - 1) * move).cast("double"))
        return F.struct(p.alias("p"), (acc["every"] + p).alias("every"), (acc["small"] + F.when(p <= EQUAL, p).otherwise(0.0)).alias("small"))

    each = F.when(steps >= 1, F.sequence(F.lit(1).cast("long"), steps.cast("long"))).otherwise(F.array().cast("array<long>"))
    return F.aggregate(each, begin, one)


def _p_value(up: Column, down: Column) -> Column:
    return F.least(F.lit(1.0), (1 + up["small"] + down["small"]) / (1 + up["every"] + down["every"]))


def hardy_weinberg_p(hom_ref: str, het: str, hom_var: str) -> Column:
    """Exact Hardy-Weinberg test of three genotype counts (NULL without genotypes).

    Given the allele counts, P(h + 2) / P(h) = 4 r c / ((h + 1)(h + 2)), r and c the homozygotes beside h heterozygotes.
    """
    a, h, b = (F.col(c).cast("long") for c in (hom_ref, het, hom_var))
    rare, common = F.least(a, b), F.greatest(a, b)

    def more(k):  # k heterozygotes: (k - h) / 2 fewer homozygotes of either kind
        off = (k - h) / 2
        return 4 * (rare - off) * (common - off) / ((k + 1) * (k + 2))

    def fewer(k):
        off = (h - k) / 2
        return k * (k - 1) / (4 * (rare + off + 1) * (common + off + 1))

    up, down = _walk(h, rare, more, 2), _walk(h, F.floor(h / 2), fewer, -2)
    return F.when(a + h + b > 0, _p_value(up, down))


def fisher_p(a: str, b: str, c: str, d: str) -> Column:
    """Two-sided Fisher exact test on [[a, b], [c, d]] (NULL for an empty table).

    With fixed margins P(k + 1) / P(k) = b' c' / ((k + 1)(d' + 1)) for the table whose upper left count is k.
    """
    a, b, c, d = (F.col(x).cast("long") for x in (a, b, c, d))
    up = _walk(a, F.least(b, c), lambda k: (b - (k - a)) * (c - (k - a)) / ((k + 1) * (d + (k - a) + 1)), 1)
    down = _walk(a, F.least(a, d), lambda k: k * (d + (k - a)) / ((b - (k - a) + 1) * (c - (k - a) + 1)), -1)
    return F.when(a + b + c + d > 0, _p_value(up, down))

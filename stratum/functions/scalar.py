"""Scalar column functions (JVM-side expressions, inside whole-stage codegen).

Each returns a ``Column``; none calls Python per row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hhmm_add_minutes(hhmm, minutes) -> Column:
    """Clock arithmetic on HHMM integers: HHMM + minutes (fraction truncated), wrapping at midnight.

    (724, 37.96) -> 801; (2355, 37.96) -> 32.
    """
    t = _c(hhmm)
    total = F.pmod(F.floor(t / 100) * 60 + F.pmod(t, F.lit(100)) + F.floor(_c(minutes)), F.lit(1440))
    return (F.floor(total / 60) * 100 + F.pmod(total, F.lit(60))).cast("int")


def predicted_arrival(sched_arr_time, dep_delay, slope: float = 1.02, offset: float = -5.9) -> Column:
    """Scheduled HHMM arrival shifted by a linear delay model ``slope*dep_delay + offset`` minutes."""
    return hhmm_add_minutes(sched_arr_time, _c(dep_delay) * F.lit(slope) + F.lit(offset))


def round_to_nearest_seconds(ts, seconds: int = 30) -> Column:
    """Timestamp rounded to the nearest multiple of ``seconds`` (ties up), as a timestamp."""
    s = _c(ts).cast("double")
    return F.timestamp_seconds((F.floor(s / seconds + F.lit(0.5)) * seconds).cast("long"))


def labelled_bucket(x, edges: Sequence[float], labels: Sequence[str] | None = None) -> Column:
    """Bucket label for ``x``: buckets are ``[lo, hi)``, the last one closed; outside or NULL → NULL."""
    if len(edges) < 2:
        raise ValueError("need at least two edges")
    labels = list(labels) if labels is not None else [f"{lo:g} to {hi:g}" for lo, hi in zip(edges, edges[1:])]
    if len(labels) != len(edges) - 1:
        raise ValueError("need one label per bucket")
    x = _c(x)
    expr = None
    n = len(labels)
    for i, (lo, hi, lab) in enumerate(zip(edges, edges[1:], labels)):
        cond = (x >= lo) & ((x <= hi) if i == n - 1 else (x < hi))
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return expr


def unhot(cols: Sequence[str], hot: float = 1.0) -> Column:
    """0-based position of the first ``hot`` value among one-hot columns; −1 when none is hot."""
    return (F.array_position(F.array(*[_c(c).cast("double") for c in cols]), F.lit(float(hot))) - 1).cast("int")


def squared_distance(a, b) -> Column:
    """Squared Euclidean distance of two equal-length numeric arrays."""
    d = F.zip_with(_c(a), _c(b), lambda x, y: (x - y) * (x - y))
    return F.aggregate(d, F.lit(0.0).cast("double"), lambda acc, v: acc + v)


def rms_distance(a, b) -> Column:
    """sqrt(squared distance) / sqrt(length): distance per coordinate, comparable across lengths."""
    return F.sqrt(squared_distance(a, b)) / F.sqrt(F.size(_c(a)).cast("double"))


def rounded(c, digits: int) -> Column:
    """``F.round`` of a double, by decimal arithmetic only near a tie or where the scaled value is too large to tell."""
    x, scale = _c(c), float(10 ** digits)
    scaled = x * scale
    sure = (F.abs(scaled) < 2.0 ** 31) & (F.abs(scaled - F.floor(scaled) - 0.5) > 1e-6)
    return F.when(sure, F.rint(scaled) / scale + 0.0).otherwise(F.round(x, digits))


def array_sum(a) -> Column:
    return F.aggregate(_c(a), F.lit(0.0).cast("double"), lambda acc, v: acc + v)


def scale_pixels(a, scale: float = 1.0 / 255.0, shift: float = -0.5) -> Column:
    """Element-wise ``x*scale + shift`` on an array (pixel normalisation)."""
    return F.transform(_c(a), lambda x: x.cast("double") * F.lit(scale) + F.lit(shift))


def great_circle_points(lon1, lat1, lon2, lat2, n: int = 100) -> Column:
    """Array of ``n`` intermediate points plus both ends along the great circle (degrees).

    Spherical linear interpolation of the two unit vectors; each element is a
    struct ``(i, lon, lat)``. Coincident ends give ``n+2`` copies of the point.
    """
    r = F.radians
    p1, l1, p2, l2 = r(_c(lat1)), r(_c(lon1)), r(_c(lat2)), r(_c(lon2))
    # central angle by the haversine formula (stable for short distances)
    h = F.pow(F.sin((p2 - p1) / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin((l2 - l1) / 2), 2)
    d = 2 * F.asin(F.sqrt(F.least(F.lit(1.0), h)))

    def point(i):
        f = i.cast("double") / F.lit(float(n + 1))
        a = F.when(d == 0, 1 - f).otherwise(F.sin((1 - f) * d) / F.sin(d))
        b = F.when(d == 0, f).otherwise(F.sin(f * d) / F.sin(d))
        x = a * F.cos(p1) * F.cos(l1) + b * F.cos(p2) * F.cos(l2)
        y = a * F.cos(p1) * F.sin(l1) + b * F.cos(p2) * F.sin(l2)
        z = a * F.sin(p1) + b * F.sin(p2)
        lat = F.degrees(F.atan2(z, F.sqrt(x * x + y * y)))
        lon = F.degrees(F.atan2(y, x))
        return F.struct(i.alias("i"), lon.alias("lon"), lat.alias("lat"))

    return F.transform(F.sequence(F.lit(0), F.lit(n + 1)), point)


def keep_true_or_missing(pred) -> Column:
    """Filter predicate that keeps rows where ``pred`` is true or NULL."""
    return F.coalesce(_c(pred), F.lit(True))


def first_of_month(year, month) -> Column:
    return F.make_date(_c(year), _c(month), F.lit(1))

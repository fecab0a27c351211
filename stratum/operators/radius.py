"""Blocks of vectors and their comparison: the two Arrow steps of ``seasons.similar_within_radius``.

A block is one row: up to some thousands of vectors of one level and length as an Arrow payload, put into leaves of ``LEAF`` rows
that lie close together, with the bounds of the whole block in a few directions. Two blocks are compared as matrix products: each
leaf of one with the rows of the other that are near its bounds. What is held at once is two blocks and products of ``TALL`` rows
with a leaf, however many pairs there are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

LEAF, TALL, FLUSH = 256, 1024, 1 << 16
#: Most bytes of a block's vectors, however long they are.
BYTES = 16 << 20
#: Coordinates that the products are made of; longer vectors are told apart by the first ones and then decided exactly.
TOLD = 18


def embedded(x: np.ndarray, classes: int) -> np.ndarray:
    """Per row: the normalised class sums and the length of what they leave over. Distances in it are at most the RMS distance."""
    n, size = x.shape
    out, left = np.zeros((n, classes + 1)), x.copy()
    for j in range(min(classes, size)):
        mine = x[:, j::classes]
        mean = mine.sum(1) / mine.shape[1]
        out[:, j] = mean * np.sqrt(mine.shape[1] / size)
        left[:, j::classes] -= mean[:, None]
    out[:, classes] = np.sqrt((left * left).sum(1) / size)
    return out


def leaf_order(points: np.ndarray, leaf: int) -> np.ndarray:
    """Order of the rows in which every ``leaf`` of them lie close together (halved along the widest direction)."""
    done, todo = [], [np.arange(len(points))]
    while todo:
        rows = todo.pop()
        if len(rows) <= leaf:
            done.append(rows)
            continue
        mine = points[rows]
        widest = int(np.argmax(mine.max(0) - mine.min(0)))
        cut = -(-len(rows) // (2 * leaf)) * leaf  # whole leaves on the left
        split = np.argpartition(mine[:, widest], cut - 1) if cut < len(rows) else np.arange(len(rows))
        todo += [rows[split[cut:]], rows[split[:cut]]]
    return np.concatenate(done) if done else np.arange(0)


def slack(x: np.ndarray) -> float:
    """More than rounding can move a point of ``embedded``."""
    return 8 * x.shape[1] * np.finfo(float).eps * np.abs(x).max()


def packer(classes: int, most: int):
    """mapInArrow step: rows (level, entity, year, number, vector), sorted by level and length, into blocks of at most ``most`` rows and ``BYTES`` bytes."""

    def block(rows: pa.Table) -> pa.RecordBatch:
        level, *own, vec = (_array(c) for c in rows.columns)
        x = vec.flatten().to_numpy(zero_copy_only=False).reshape(rows.num_rows, -1)
        points = embedded(x, classes)
        order = leaf_order(points, LEAF)
        sink = pa.BufferOutputStream()
        for t in (pa.table([c.take(pa.array(order)) for c in own], names=rows.schema.names[1:4]),
                  pa.table({"values": np.ascontiguousarray(x[order].T).ravel()})):  # one coordinate after the other
            with pa.ipc.new_stream(sink, t.schema) as w:
                w.write_table(t)
        room = slack(x)
        edges = [pa.array([v.tolist()], pa.list_(pa.float64())) for v in (points.min(0) - room, points.max(0) + room)]
        return pa.RecordBatch.from_arrays([level.slice(0, 1), pa.array([x.shape[1]], pa.int32()), *edges, pa.array([sink.getvalue().to_pybytes()], pa.binary())],
                                          names=[rows.schema.names[0], "_len", "_lo", "_hi", "_rows"])

    def run(batches):
        held, count, key = [], 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            level, size = batch.column(0), pc.list_value_length(batch.column(4))
            new = np.ones(batch.num_rows, bool)
            new[1:] = ~(pc.equal(level.slice(1), level.slice(0, len(level) - 1)).to_numpy(zero_copy_only=False)
                        & pc.equal(size.slice(1), size.slice(0, len(size) - 1)).to_numpy(zero_copy_only=False))
            starts = [*np.flatnonzero(new).tolist(), batch.num_rows]
            for a, b in zip(starts, starts[1:]):
                now = (level[a].as_py(), size[a].as_py())
                if held and now != key:
                    yield block(pa.Table.from_batches(held))
                    held, count = [], 0
                key, full = now, min(most, max(1, BYTES // (8 * now[1])))
                while a < b:
                    part = batch.slice(a, min(b - a, full - count))
                    held.append(part)
                    count, a = count + part.num_rows, a + part.num_rows
                    if count == full:
                        yield block(pa.Table.from_batches(held))
                        held, count = [], 0
        if held:
            yield block(pa.Table.from_batches(held))

    return run


def _array(c):
    return c if isinstance(c, pa.Array) else c.chunk(0) if c.num_chunks == 1 else pa.concat_arrays(c.chunks)


class _Block:
    """A block's rows; ``x`` has one coordinate per row, as the payload has."""

    def __init__(self, payload: pa.Scalar, size: int, classes: int):
        source = pa.BufferReader(payload.as_buffer())
        own, values = (pa.ipc.open_stream(source).read_all() for _ in range(2))
        self.entity, self.year, number = (_array(c) for c in own.columns)
        self.number = number.to_numpy()
        self.x = _array(values.column(0)).to_numpy().reshape(size, -1)
        rows = self.x.T
        points, room, at = embedded(rows, classes), slack(rows), np.arange(0, len(rows), LEAF)
        self.points = np.ascontiguousarray(points.T)
        self.lo, self.hi = np.minimum.reduceat(points, at) - room, np.maximum.reduceat(points, at) + room
        self.room = room


def _matrices(x: np.ndarray, y: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Single-precision factors whose product is never above the squared distance of the rows (its columns here) by more than rounding.

    |a|² + |b|² - 2ab in k terms is off by at most about 2 k ulp (|a|² + |b|²), which is taken off the squares beforehand.
    """
    size = len(x)
    middle = (x.mean(1) + y.mean(1))[:, None] / 2  # distances do not change, squares shrink
    off = 1 - 4 * (size + 8) * 2.0 ** -24
    with np.errstate(over="ignore", invalid="ignore"):
        def told(z):
            z = z - middle
            return z, (z * z).sum(0) * off

        a, aa = told(x)
        b, bb = (a, aa) if same else told(y)
        left = np.concatenate([-2 * a, aa[None], np.ones((1, a.shape[1]))]).T.astype(np.float32)
        right = np.concatenate([b, np.ones((1, b.shape[1])), bb[None]]).astype(np.float32)
    return np.ascontiguousarray(left), np.ascontiguousarray(right)


def candidates(a: _Block, b: _Block, same: bool, radius: float):
    """(rows of a, rows of b) of all pairs within the radius and few others, each unordered pair once, in pieces."""
    size, n, m = len(a.x), a.x.shape[1], b.x.shape[1]
    reach = radius * (1 + 1e-9)
    limit = np.float32(size * reach * reach * (1 + 1e-6) + 1e-30)
    left, right = _matrices(a.x[:TOLD], b.x[:TOLD], same)
    product, close = np.empty(TALL * LEAF, np.float32), np.empty(TALL * LEAF, bool)
    for j in range(len(b.lo)):
        start, end = j * LEAF, min((j + 1) * LEAF, m)
        rows = np.arange(end if same else n)
        gaps = np.zeros(len(rows))
        for point, lo, hi in zip(a.points, b.lo[j] - a.room, b.hi[j] + a.room):
            at = point[:len(rows)]
            gap = np.maximum(lo - at, at - hi)
            np.maximum(gap, 0, out=gap)
            gap *= gap
            gaps += gap
        rows = rows[~(gaps > reach * reach)]
        other = np.ascontiguousarray(right[:, start:end])
        for c in range(0, len(rows), TALL):
            some = rows[c:c + TALL]
            p, ok = (v[:len(some) * (end - start)].reshape(len(some), end - start) for v in (product, close))
            with np.errstate(over="ignore", invalid="ignore"):
                np.matmul(left[some], other, out=p)
                np.greater(p, limit, out=ok)
            np.logical_not(ok, out=ok)  # what overflowed stays a candidate
            found = np.flatnonzero(ok)
            if len(found):
                row, col = np.divmod(found, end - start)
                row, col = some[row], col + start
                if same:
                    once = row < col
                    row, col = row[once], col[once]
                yield row, col


def comparer(radius: float, classes: int, names: list[str]):
    """mapInArrow step: rows (level, length, same, block, block) into result rows of both directions."""

    def told(level, a, b, row, col):
        """Result batches of the candidates that are pairs, in both directions."""
        total = np.zeros(len(row))
        for x, y in zip(a.x, b.x):
            d = x[row] - y[col]
            total += d * d
        score = np.sqrt(total) / np.sqrt(float(len(a.x)))
        good = score <= radius
        equal = np.flatnonzero(a.number[row] == b.number[col])  # the same entity, or by chance the same number
        if len(equal):
            alike = pc.equal(a.entity.take(pa.array(row[equal])), b.entity.take(pa.array(col[equal])))
            good[equal[alike.to_numpy(zero_copy_only=False)]] = False
        if not good.all():
            row, col, score = row[good], col[good], score[good]
        if len(row):
            i, j, score, same = pa.array(row), pa.array(col), pa.array(score), pa.repeat(level, len(row))
            one, two = a.entity.take(i), b.entity.take(j)
            yield pa.RecordBatch.from_arrays([same, a.year.take(i), one, two, score], names=names)
            yield pa.RecordBatch.from_arrays([same, b.year.take(j), two, one, score], names=names)

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                level, size, same = batch.column(0)[k], batch.column(1)[k].as_py(), batch.column(2)[k].as_py()
                a = _Block(batch.column(3)[k], size, classes)
                b = a if same else _Block(batch.column(4)[k], size, classes)
                held, count = [], 0
                for pair in candidates(a, b, same, radius):
                    held.append(pair)
                    count += len(pair[0])
                    if count >= FLUSH:
                        row, col = (np.concatenate(v) for v in zip(*held))
                        for c in range(0, len(row), FLUSH):
                            yield from told(level, a, b, row[c:c + FLUSH], col[c:c + FLUSH])
                        held, count = [], 0
                if held:
                    yield from told(level, a, b, *(np.concatenate(v) for v in zip(*held)))

    return run

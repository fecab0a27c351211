"""Suffix-array deduplication: remove every byte covered by a string of ``length`` bytes that starts anywhere else too.

1. Anchors. Every window of ``length`` bytes has an anchor: of its ``GRAM``-byte strings the one with the smallest hash,
   the leftmost of these on a tie. Equal windows have the same anchor at the same place, so windows whose anchor's hash
   occurs once in the corpus are certainly unique. A scan lists the anchors with the stretch of windows each one serves,
   equal stretches counted together before the shuffle.
2. Suffix sorting. The stretches (text and all) of anchors that recur are dealt out by anchor, equal ones once, with their
   number. Each task sorts the suffixes of its text in two stages: only the suffixes smaller than their successors are
   sorted directly; the others follow by scanning the first-byte buckets in order. Neighbours in the array with a common
   prefix of ``length`` bytes, and stretches that occur twice, give the repeated windows. An anchor with very many
   different stretches (text around a passage that countless documents share) is not put into one task. Equal windows
   have their anchor equally far from their start, so the windows are cut into ranges of that distance, and all windows
   of a range hold the same core of bytes around the anchor: the pieces of stretches are dealt out by their core, equal
   pieces once, and each core's pieces are sorted the same way. Cores that are still shared by very many different
   pieces are dealt again by ranges a quarter as wide, whose cores are longer; a range of one window is its own core.
3. Removal. A second scan joins each document's stretches to the repeated windows, and each document to its windows.

Null and empty texts have 0 bytes and keep them; texts shorter than ``length`` lose nothing; equal rows repeat each other
(each of their strings starts elsewhere), also those with the same id; each is cut once, whatever their number. Very long
texts are scanned in pieces that overlap by ``length`` - 1 bytes. An empty table gives an empty result; other columns are
not read, so extra ones cannot clash.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_shuffles, id_text, table

GRAM = 64
#: Bytes scanned at a time; positions must fit into 20 bits.
BLOCK = 1 << 18
#: Anchors gathered before a task counts equal ones together.
FLUSH = 150_000
#: Rows handled at a time in a task.
ROWS = 512
#: Bytes sorted at a time, and different stretches of one anchor (or pieces of one core) up to which one task sorts them.
SORT_BYTES = 1 << 19
CROWD = 2000
#: Bytes of stretches dealt to one task, about.
TASK_BYTES = 8 << 20

_random = np.random.RandomState(5)
CODE = _random.randint(1, 1 << 62, (2, 256)).astype(np.uint64)
BASE = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_powers: list = []


def powers():
    """Powers of both bases and of their inverses modulo 2^64."""
    if not _powers:
        for base in BASE:
            up = np.full(BLOCK * 2 + 1, base, np.uint64)
            down = np.full(BLOCK * 2 + 1, pow(base, -1, 1 << 64), np.uint64)
            up[0] = down[0] = 1
            _powers.append((np.multiply.accumulate(up), np.multiply.accumulate(down)))
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    return x ^ (x >> np.uint64(29))


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, by running minima from both ends of blocks."""
    n = len(x) - width + 1
    pad = -len(x) % width
    blocks = np.concatenate([x, np.full(pad, x.max(), x.dtype)]).reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1:width - 1 + n])


def anchors(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int):
    """For texts data[starts[i]:ends[i]] lying side by side: (text, anchor hash, stretch hash, first window, last window)
    of each anchor, windows as offsets into data."""
    if len(data) < length:
        return None
    (up, down), (up2, down2) = powers()
    n = len(data)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(CODE[0][data] * up[:n], out=total[1:])
    gram = mix((total[GRAM:] - total[:-GRAM]) * down[:n - GRAM + 1])
    order = gram >> np.uint64(20) << np.uint64(20) | np.arange(len(gram), dtype=np.uint64)
    place = (sliding_min(order, length - GRAM + 1) & np.uint64((1 << 20) - 1)).astype(np.int64)
    text = np.repeat(np.arange(len(starts)), ends - starts)[:len(place)]
    inside = np.arange(len(place)) + length <= ends[text]
    new = np.ones(len(place), bool)
    new[1:] = (place[1:] != place[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new & inside)
    if not len(first):
        return None
    stop = np.flatnonzero(np.concatenate([new[1:] | ~inside[1:], [True]]) & inside)
    np.cumsum(CODE[1][data] * up2[:n], out=total[1:])
    lead, size = (place[first] - first).astype(np.uint64), (stop - first).astype(np.uint64)
    whole = mix((total[stop + length] - total[first]) * down2[first] + mix(lead * np.uint64(BASE[0]) + size * np.uint64(BASE[1])))
    return text[first], gram[place[first]].view(np.int64), whole.view(np.int64), first, stop


def blocks(texts: list[bytes], length: int):
    """(data, row of each piece, its offset in the row, starts, ends): short texts together, long ones in pieces that
    overlap by length - 1 bytes, so that each window lies in exactly one piece."""
    rows, offsets, pieces, size = [], [], [], 0
    for row, text in enumerate(texts):
        for at in range(0, max(1, len(text) - length + 1), BLOCK - length + 1):
            piece = text[at:at + BLOCK]
            if len(piece) < length:
                continue
            if size + len(piece) > BLOCK:
                yield _block(rows, offsets, pieces)
                rows, offsets, pieces, size = [], [], [], 0
            rows.append(row)
            offsets.append(at)
            pieces.append(piece)
            size += len(piece)
    if rows:
        yield _block(rows, offsets, pieces)


def _block(rows, offsets, pieces):
    ends = np.cumsum([len(p) for p in pieces])
    starts = np.concatenate([[0], ends[:-1]])
    return np.frombuffer(b"".join(pieces), np.uint8), np.array(rows), np.array(offsets), starts, ends


def _key(id_col: str, text_col: str) -> list:
    """128 bits that name an id with its text; rows with equal ones have equal results."""
    return [F.xxhash64(id_col, text_col).alias("k1"), F.xxhash64(F.lit(1), text_col, id_col).alias("k2")]


def scan(docs: DataFrame, length: int, combine: bool) -> DataFrame:
    """Anchors of all documents: anchor, stretch (hashes), k1, k2 (of id and text), start (of the stretch's first window in
    its text), windows, n. With ``combine``, equal stretches met by a task are one row with their number and one place."""
    rows = docs.select(*_key("doc_id", "text"), "text")
    fields = ["anchor", "stretch", "k1", "k2", "start", "windows", "n"]

    def run(batches):
        held, size = [], 0

        def flush():
            cols = [np.concatenate([h[k] for h in held]) for k in range(6)]
            n = np.ones(len(cols[0]), np.int64)
            if combine:
                order = np.lexsort((cols[1], cols[0]))
                new = np.ones(len(order), bool)
                new[1:] = (cols[0][order][1:] != cols[0][order][:-1]) | (cols[1][order][1:] != cols[1][order][:-1])
                at = np.flatnonzero(new)
                n = np.diff(np.append(at, len(order)))
                keep = order[at]
                cols = [c[keep] for c in cols]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in (*cols, n)], names=fields)

        for batch in (b.slice(at, ROWS) for b in batches for at in range(0, b.num_rows, ROWS)):
            k1, k2 = (batch.column(k).to_numpy() for k in (0, 1))
            texts = batch.column(2).cast(pa.binary()).to_pylist()
            for data, owner, offset, starts, ends in blocks(texts, length):
                found = anchors(data, starts, ends, length)
                if found is None:
                    continue
                piece, anchor, stretch, first, stop = found
                mine = owner[piece]
                held.append((anchor, stretch, k1[mine], k2[mine], first - starts[piece] + offset[piece], stop - first + 1))
                size += len(anchor)
                if size >= FLUSH:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    return rows.mapInArrow(run, ", ".join(f"{f} long" for f in fields))


def suffix_array(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, depth: int, tail: int = 0) -> np.ndarray:
    """Suffixes of the texts data[starts[i]:ends[i]] in order of their first ``depth`` bytes at least.

    Those that start in a text's last ``tail`` bytes are left out, but for the few from which others are induced.
    """
    n = len(data)
    last = np.zeros(n, bool)
    last[ends - 1] = True
    begins = np.zeros(n, bool)
    begins[starts] = True
    step = np.zeros(n, np.int8)  # -1: greater than its successor, 1: smaller; equal bytes follow their successor
    step[:-1] = np.sign(data[1:].astype(np.int16) - data[:-1])
    step[last] = -1
    known = np.where(step != 0, np.arange(n), n - 1)
    known = np.minimum.accumulate(known[::-1])[::-1]
    small = step[known] > 0
    # stage one: the suffixes smaller than their successors, directly; those cut off by the end of their text come first
    end_of = np.repeat(ends, ends - starts)
    padded = np.concatenate([data, np.zeros(depth, np.uint8)])
    after = np.minimum.accumulate(np.where(small, np.arange(n), n)[::-1])[::-1]  # the next smaller suffix, itself included
    bound = np.minimum(after[np.maximum(ends - 1 - tail, starts)], ends - 1)
    s = np.flatnonzero(small & (np.arange(n) <= np.repeat(bound, ends - starts)))
    s = s[np.argsort(end_of[s] - s >= depth, kind="stable")]
    grid = np.lib.stride_tricks.sliding_window_view(padded, depth)[s]
    cut = np.flatnonzero(end_of[s] - s < depth)
    if len(cut):
        grid[cut] = np.where(np.arange(depth) < (end_of[s[cut]] - s[cut])[:, None], grid[cut], 0)
    s = s[np.argsort(grid.view(f"S{depth}").ravel(), kind="stable")]
    del grid
    own = data[s]
    edge = np.searchsorted(own, np.arange(257))
    # stage two: bucket by bucket; a greater suffix stands where its successor's place puts it
    waiting: dict[int, list[np.ndarray]] = {}

    def push(at: np.ndarray) -> None:
        byte = data[at]
        order = np.argsort(byte, kind="stable")
        at, byte = at[order], byte[order]
        cuts = np.flatnonzero(np.diff(byte)) + 1
        for part in np.split(at, cuts) if len(at) else ():
            waiting.setdefault(int(data[part[0]]), []).append(part)

    push((ends - 1)[~small[bound]])
    out = []
    for byte in range(256):
        bucket = waiting.pop(byte, [])
        now = np.concatenate(bucket) if bucket else np.zeros(0, np.int64)
        while len(now):
            now = now[~begins[now]] - 1
            now = now[data[now] == byte]
            if len(now):
                bucket.append(now)
        bucket.append(s[edge[byte]:edge[byte + 1]])
        whole = np.concatenate(bucket)
        if len(whole):
            out.append(whole)
            before = whole[~begins[whole]] - 1
            push(before[data[before] > byte])
    return np.concatenate(out)


def repeated(contents: list[bytes], numbers: np.ndarray, length: int) -> list[np.ndarray]:
    """For each stretch (equal ones occur ``numbers`` times), which of its windows occur anywhere else."""
    sizes = np.array([len(c) for c in contents])
    ends = np.cumsum(sizes)
    starts = ends - sizes
    data = np.frombuffer(b"".join(contents), np.uint8)
    sa = suffix_array(data, starts, ends, length, length - 1)
    end_of = np.repeat(ends, sizes)
    sa = sa[end_of[sa] - sa >= length]  # windows keep their order
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    words = np.lib.stride_tricks.sliding_window_view(padded, 8).copy().view(np.uint64).ravel()
    pair = np.arange(1, len(sa))  # common prefixes of neighbours, eight bytes at a time, while they agree
    offsets = [*range(0, length - 7, 8), *([length - 8] if length % 8 else [])]
    for k in offsets:
        pair = pair[words[sa[pair - 1] + k] == words[sa[pair] + k]]
    hit = np.repeat(numbers > 1, sizes)
    hit[sa[pair]] = hit[sa[pair - 1]] = True
    return [hit[a:b - length + 1] for a, b in zip(starts, ends)]


def runs(hit: np.ndarray) -> tuple[list[int], list[int]]:
    """First and last positions of the stretches of true values."""
    edge = np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1).tolist(), (np.flatnonzero(edge == -1) - 1).tolist()


def repeated_windows(docs: DataFrame, length: int) -> DataFrame:
    """(anchor, stretch, firsts, lasts): the repeated windows of each stretch, as runs of offsets into it. Written."""
    spark = docs.sparkSession
    met = scan(docs, length, True)
    # one shuffle by anchor; a task has sent each different stretch once
    parts = met.repartition("anchor").groupBy("anchor", "stretch").agg(
        F.sum("n").alias("n"), F.min(F.struct("k1", "k2", "start", "windows")).alias("place")).select("anchor", "stretch", "n", "place.*")
    known = table(parts, "stretches")
    free_shuffles(spark)
    per = table(known.groupBy("anchor").agg(F.sum("n").alias("total"), F.count("*").alias("kinds")).where("total > 1"), "anchors")
    wanted = table(known.join(per, "anchor"), "recurring")
    bytes_ = wanted.agg(F.sum(F.col("windows") + length)).first()[0] or 0
    lists = wanted.groupBy("k1", "k2").agg(F.collect_list(F.struct("anchor", "stretch", "start", "windows", "n", "kinds")).alias("list"))
    # one of several rows with the same id and text is cut
    with_text = (docs.select(*_key("doc_id", "text"), "text").join(lists, ["k1", "k2"]).groupBy("k1", "k2")
                 .agg(F.first("text").alias("text"), F.first("list").alias("list")).select("text", "list"))

    def cut(batches):
        for batch in batches:
            texts, lists_ = batch.column(0).cast(pa.binary()), batch.column(1)
            for i in range(batch.num_rows):
                text, entries = texts[i].as_py(), lists_.slice(i, 1).flatten()
                cols = [c.to_numpy() for c in entries.flatten()]
                content = [text[a:a + w + length - 1] for a, w in zip(cols[2].tolist(), cols[3].tolist())]
                yield pa.RecordBatch.from_arrays([pa.array(cols[0]), pa.array(cols[1]), pa.array(cols[4]), pa.array(cols[5]),
                                                  pa.array(content, pa.binary())], names=["anchor", "stretch", "n", "kinds", "content"])

    contents = with_text.mapInArrow(cut, "anchor long, stretch long, n long, kinds long, content binary")
    contents = table(contents, "contents")
    free_shuffles(spark)
    tasks = max(1, int(-(-bytes_ // TASK_BYTES)))
    usual = contents.where(F.col("kinds") <= CROWD).select("anchor", "stretch", "n", "content")

    def sort(batches):
        for group in _groups(batches):
            order = np.argsort(group[0], kind="stable")
            anchor, stretch, number = (c[order] for c in group[:3])
            content = [group[3][i] for i in order]
            weight = np.cumsum([len(c) for c in content])
            first = 0
            while first < len(content):  # whole anchors, about SORT_BYTES at a time
                stop = int(np.searchsorted(weight, (weight[first - 1] if first else 0) + SORT_BYTES, "right"))
                stop = int(np.searchsorted(anchor, anchor[min(max(stop, first + 1), len(content)) - 1], "right"))
                found = [runs(h) for h in repeated(content[first:stop], number[first:stop], length)]
                keep = [i for i, f in enumerate(found) if f[0]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor[first:stop][keep]), pa.array(stretch[first:stop][keep]),
                     pa.array([found[i][0] for i in keep], pa.list_(pa.int64())), pa.array([found[i][1] for i in keep], pa.list_(pa.int64()))],
                    names=["anchor", "stretch", "firsts", "lasts"])
                first = stop

    schema = "anchor long, stretch long, firsts array<long>, lasts array<long>"
    found = table(usual.repartition(tasks, "anchor").mapInArrow(sort, schema), "repeated")
    crowd = contents.where(F.col("kinds") > CROWD).select("anchor", "stretch", "n", F.lit(0).alias("at"), F.lit(-1).alias("lead"), "content")
    width = 4 ** max(0, int(np.ceil(np.log2(length - GRAM + 1) / 2)) - 1)  # below the number of distances
    while not crowd.isEmpty():
        some, crowd = _by_core(crowd, length, width, sort)
        found, width = found.unionByName(some), max(1, width // 4)
    return found


def _groups(batches):
    """All rows of a task: anchors lie whole in one task, whose share is bounded by TASK_BYTES and CROWD."""
    held = [[], [], [], []]
    for batch in batches:
        for k in range(3):
            held[k].append(batch.column(k).to_numpy())
        held[3] += batch.column(3).to_pylist()
    if held[3]:
        yield *(np.concatenate(h) for h in held[:3]), held[3]


def lead_of(content: bytes, length: int) -> int:
    """How far from the start of a stretch its anchor lies."""
    (up, down), _ = powers()
    data = np.frombuffer(content[:length], np.uint8)
    total = np.zeros(length + 1, np.uint64)
    np.cumsum(CODE[0][data] * up[:length], out=total[1:])
    return int(np.argmin(mix((total[GRAM:] - total[:-GRAM]) * down[:length - GRAM + 1]) >> np.uint64(20)))


def pieces(content: bytes, lead: int, length: int, width: int):
    """(range, core, offset, piece) of a stretch's windows, cut into ranges of ``width`` distances from start to anchor."""
    windows = len(content) - length + 1
    for k in range((lead - windows + 1) // width, lead // width + 1):
        first, last = max(0, lead - (k + 1) * width + 1), min(windows - 1, lead - k * width)
        core = lead - k * width  # the latest start in the range; the earliest one ends width - 1 bytes before its end
        yield k, content[core:core + length - width + 1], first, content[first:last + length]


def _by_core(crowd: DataFrame, length: int, width: int, sort) -> tuple[DataFrame, DataFrame]:
    """(repeated windows as (anchor, stretch, firsts, lasts), pieces whose core is still shared by too many). Written."""
    def split(batches):
        import xxhash

        for batch in (b.slice(at, ROWS) for b in batches for at in range(0, b.num_rows, ROWS)):
            anchor, stretch, n, at, lead = (batch.column(k).to_pylist() for k in range(5))
            out = []
            for i, content in enumerate(batch.column(5).to_pylist()):
                here = lead[i] if lead[i] >= 0 else lead_of(content, length)
                for k, core, first, piece in pieces(content, here, length, width):
                    name = b"%d:%d:" % (anchor[i], k)
                    out.append((xxhash.xxh3_64_intdigest(name + core) - (1 << 63), xxhash.xxh3_64_intdigest(name + piece, 7) - (1 << 63),
                                anchor[i], stretch[i], n[i], at[i] + first, here - first, piece))
            kinds = [pa.int64()] * 5 + [pa.int32()] * 2 + [pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], t) for k, t in enumerate(kinds)],
                                             names=["core", "piece", "anchor", "stretch", "n", "at", "lead", "content"])

    each = table(crowd.mapInArrow(split, "core long, piece long, anchor long, stretch long, n long, at int, lead int, content binary"), "pieces")
    kinds = table(each.groupBy("core", "piece").agg(F.sum("n").alias("n"), F.first("content").alias("content")), "piece-kinds")
    per = table(kinds.groupBy("core").agg(F.sum("n").alias("total"), F.count("*").alias("kinds")).where("total > 1"), "cores")
    usual = kinds.join(per.where(F.col("kinds").between(2, CROWD)).select("core"), "core").select("core", "piece", "n", "content")
    bytes_ = usual.agg(F.sum(F.length("content"))).first()[0] or 0
    schema = "anchor long, stretch long, firsts array<long>, lasts array<long>"
    spots = usual.repartition(max(1, int(-(-bytes_ // TASK_BYTES))), "core").mapInArrow(sort, schema)
    spots = table(spots.select(F.col("anchor").alias("core"), F.col("stretch").alias("piece"), "firsts", "lasts"), "piece-repeated")
    mine = each.select("core", "piece", "anchor", "stretch", "at")

    def moved(c: str):
        return F.transform(c, lambda x: x + F.col("at")).alias(c)

    sorted_ = mine.join(spots, ["core", "piece"]).select("anchor", "stretch", moved("firsts"), moved("lasts"))
    last = F.col("at") + F.length("content") - length
    same = each.join(per.where("kinds = 1").select("core"), "core", "left_semi").select(  # all equal: every window is repeated
        "anchor", "stretch", F.array(F.col("at").cast("long")).alias("firsts"), F.array(last.cast("long")).alias("lasts"))
    many = each.join(per.where(F.col("kinds") > CROWD).select("core"), "core", "left_semi")
    return table(sorted_.unionByName(same), "repeated"), many.select("anchor", "stretch", "n", "at", "lead", "content")


def dedup(df: DataFrame, length: int = 200, id_col: str = "doc_id", text_col: str = "text", with_kept: bool = False,
          keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256; ``with_kept`` adds kept (the bytes left).

    ``keep`` names further input columns to return, in front.
    """
    docs = id_text(df, id_col, text_col)
    spark = docs.sparkSession
    found = repeated_windows(docs, length)
    hits = (scan(docs, length, False).join(found, ["anchor", "stretch"])
            .select("k1", "k2", F.explode(F.arrays_zip((F.transform("firsts", lambda x: x + F.col("start"))).alias("a"),
                                                            (F.transform("lasts", lambda x: x + F.col("start"))).alias("b"))).alias("run")))
    # rows with the same id and text have the same runs: a set, merged before the shuffle
    spans = table(hits.groupBy("k1", "k2").agg(F.collect_set("run").alias("spans")), "spans")
    free_shuffles(spark)
    extra = [F.col(c) for c in keep]
    rows = df.select(*[c.alias(f"_keep{i}") for i, c in enumerate(extra)], F.col(id_col).alias("_id"),
                     F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    joined = rows.select("*", *_key("_id", "text")).join(spans, ["k1", "k2"], "left")
    joined = joined.select(*[f"_keep{i}" for i in range(len(extra))], "_id", "text", "spans")
    lead, m = [df.schema[c] for c in keep], len(extra)
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def finish(batches):
        for batch in (b.slice(at, ROWS) for b in batches for at in range(0, b.num_rows, ROWS)):
            out = []
            for i, text in enumerate(batch.column(m + 1).cast(pa.binary()).to_pylist()):
                spans_ = batch.column(m + 2)
                if not spans_[i].is_valid:
                    out.append((len(text), 0, 0, hashlib.sha256(text).hexdigest(), text))
                    continue
                a, b = (c.to_numpy() for c in spans_.slice(i, 1).flatten().flatten())
                edge = np.zeros(len(text) + 1, np.int64)
                np.add.at(edge, a, 1)
                np.add.at(edge, b + length, -1)
                gone = np.cumsum(edge[:-1]) > 0
                kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
                out.append((len(text), int(gone.sum()), len(runs(gone)[0]), hashlib.sha256(kept).hexdigest(), kept))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            columns = [pa.array([o[k] for o in out], t) for k, t in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(m + 1)), *columns[:4 + with_kept]],
                                             names=[*(f"_keep{i}" for i in range(m)), "doc_id", *names[:4 + with_kept]])

    names = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
    schema = ", ".join([*(f"_keep{i} {f.dataType.simpleString()}" for i, f in enumerate(lead)), f"doc_id {id_type}", "n_bytes long, n_removed long, "
                        "n_spans long, kept_sha256 string" + (", kept binary" if with_kept else "")])
    made = joined.mapInArrow(finish, schema)
    return made.select(*[F.col(f"_keep{i}").alias(c) for i, c in enumerate(keep)], *[c for c in made.columns if not c.startswith("_keep")]) if keep else made

"""Conversation prefix trie: ternary search trees over dictionary-encoded turn ids, one per range shard, merged at their borders.

A node stands for a distinct sequence of first turns (role, text); the root is the empty sequence. Its members are the
conversations that start with it.

1. Dictionary. Each distinct (role, text) gets a number; texts are read for their 128-bit digest and length alone and are never
   shuffled. A conversation becomes one row of (number, bytes).
2. Shards. The rows are sorted by range over (numbers, conversation), so copies of one conversation may fill several shards.
   Each task inserts its distinct sequences into a ternary search tree, the median of a sorted range before its halves, which
   keeps the trees of siblings balanced. A traversal with its own stack lists parents before children; run backwards over the
   list it accumulates members, leaves and savings.
3. Borders. Only prefixes of a shard's first and last sequence can lie in another shard too. A task gives such nodes under a
   digest of the prefix, with what its inner nodes add below them. They are merged by digest, and subtree sums over the merged
   nodes follow by pointer doubling, in as many steps as the logarithm of their depth.

Null roles and texts are empty; turns are ordered by number, nulls first, then by digest. Null conversation ids are not read.
Repeated rows are turns of their own. A conversation without turns is a member of the root alone; an empty table has no nodes.
A conversation's numbers (16 bytes a turn) are one row, its texts however long never are. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
from array import array

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table

#: Turns in a shard, about: a task holds its shard's tree, some hundred bytes a node.
SHARD_TURNS = 1_000_000
#: Conversation ids in one piece of an id list that may go on in the next shard.
PIECE = 4096
ROOT = bytes(16)
NOTHING = hashlib.sha256(b"").hexdigest()


def sequences(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Written: conv_id, seq (array of id and bytes, in order) of the conversations in a table of turns."""
    rows = df.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv_id"), F.col(turn).alias("turn"), F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    digest = F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary")))
    rows = table(rows.select("conv_id", "turn", digest.alias("digest"), F.octet_length("text").cast("long").alias("bytes")), "trie-turns")
    words = table(rows.select("digest").distinct().withColumn("id", F.monotonically_increasing_id()), "trie-dictionary")
    place = F.struct(F.col("turn").isNotNull().alias("told"), "turn", "digest", "id", "bytes")
    return table(rows.join(words, "digest").groupBy("conv_id").agg(F.array_sort(F.collect_list(place)).alias("seq"))
                 .select("conv_id", F.transform("seq", lambda x: F.struct(x["id"].alias("id"), x["bytes"].alias("bytes"))).alias("seq")),
                 "trie-sequences")


def rebuilt(seqs: DataFrame, group: int = 5, most: int = 9) -> DataFrame:
    """Every conversation c with its first h turns taken from conversation c - c % group; h = crc32(decimal c) % most."""
    heads = seqs.select(F.col("conv_id").alias("_from"), F.slice("seq", 1, most - 1).alias("_head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")
    joined = seqs.withColumn("_h", h).withColumn("_from", F.col("conv_id") - F.col("conv_id") % group).join(heads, "_from", "left")
    none = F.array().cast(seqs.schema["seq"].dataType)
    return joined.select("conv_id", F.concat(F.coalesce(F.slice("_head", F.lit(1), F.col("_h")), none),
                                             F.slice("seq", F.col("_h") + 1, F.greatest(F.size("seq"), F.lit(1)))).alias("seq"))


def below(key: bytes, word: int) -> bytes:
    """The digest of a prefix with one more turn."""
    return hashlib.blake2b(key + word.to_bytes(8, "little", signed=True), digest_size=16).digest()


class Tree:
    """A ternary search tree: every node is a prefix; ``eq`` is the root of its children's search tree, by ``lo`` and ``hi``."""

    def __init__(self):
        self.word, self.lo, self.eq, self.hi, self.up, self.depth, self.bytes = (array("q", [0]) for _ in range(7))
        self.up[0] = -1
        self.n, self.least = array("q", [0]), array("q", [(1 << 63) - 1])
        self.end: dict[int, str] = {}

    def child(self, at: int, word: int, size: int) -> int:
        """The child of ``at`` for a turn, made where there is none."""
        way, node = self.eq, self.eq[at]
        side = at
        while node:
            if word == self.word[node]:
                return node
            side, way = node, self.lo if word < self.word[node] else self.hi
            node = way[node]
        way[side] = new = len(self.word)
        for column, value in ((self.word, word), (self.lo, 0), (self.eq, 0), (self.hi, 0), (self.up, at), (self.depth, self.depth[at] + 1),
                              (self.bytes, size), (self.n, 0), (self.least, (1 << 63) - 1)):
            column.append(value)
        return new

    def path(self, words, sizes) -> list[int]:
        nodes = [0]
        for w, b in zip(words, sizes):
            nodes.append(self.child(nodes[-1], w, b))
        return nodes

    def insert(self, words, sizes, n: int, least: int, end: str) -> None:
        nodes = self.path(words, sizes)
        for node in nodes:
            self.n[node] += n
            self.least[node] = min(self.least[node], least)
        self.end[nodes[-1]] = end

    def order(self):
        """All nodes, parents before children."""
        stack = [0]
        while stack:
            node = stack.pop()
            yield node
            kin = [self.eq[node]]
            while kin:
                k = kin.pop()
                if k:
                    stack.append(k)
                    kin += (self.lo[k], self.hi[k])


COLUMNS = {"border": "boolean", "key": "binary", "parent_key": "binary", "conv_id": "long", "depth": "long", "parent_conv_id": "long",
           "n_convs": "long", "n_children": "long", "n_leaves": "long", "saved_tokens": "long", "bytes": "long", "ends": "string",
           "shard": "int", "piece": "int", "ids": "string"}
TYPES = {"boolean": pa.bool_(), "binary": pa.binary(), "long": pa.int64(), "string": pa.string(), "int": pa.int32()}


def shard_nodes(sequences, shard: int):
    """Rows (COLUMNS) of one shard's sorted (conv_id, words, sizes): inner nodes, border nodes, pieces of border id lists."""
    words, sizes, starts, runs = array("q"), array("q"), array("q", [0]), []
    sha, now, pieces, first_ids, ids = None, None, [], None, []

    def close():
        nonlocal first_ids
        runs.append((len(ids_seen), ids_seen[0], sha.hexdigest()))
        if first_ids is None:
            first_ids = ids_seen

    ids_seen = array("q")
    for conv, own, size in sequences:
        if own != now:
            if now is not None:
                close()
            now, sha, ids_seen = own, hashlib.sha256(), array("q")
            words.extend(own)
            sizes.extend(size)
            starts.append(len(words))
        sha.update((b"," if ids_seen else b"") + str(conv).encode())
        ids_seen.append(conv)
    if now is None:
        return
    close()
    tree, ranges = Tree(), [(0, len(runs))]
    while ranges:
        low, high = ranges.pop()
        if low < high:
            mid = (low + high) // 2
            a, b = starts[mid], starts[mid + 1]
            tree.insert(words[a:b], sizes[a:b], *runs[mid])
            ranges += [(mid + 1, high), (low, mid)]
    border: dict[int, bytes] = {}
    for run, some in ((0, first_ids), (len(runs) - 1, ids_seen)):
        a, b = starts[run], starts[run + 1]
        nodes = tree.path(words[a:b], sizes[a:b])
        key = ROOT
        border[0] = key
        for node in nodes[1:]:
            key = below(key, tree.word[node])
            border[node] = key
        if nodes[-1] in tree.end:  # its list may go on in other shards
            del tree.end[nodes[-1]]
            for at in range(0, len(some), PIECE):
                pieces.append((key, at // PIECE, ",".join(map(str, some[at:at + PIECE]))))
    order = array("q", tree.order())
    children, leaves, saved = (array("q", bytes(8 * len(order))) for _ in range(3))
    for node in reversed(order):
        if node not in border:
            if not children[node]:
                leaves[node] = 1
            saved[node] += (tree.n[node] - 1) * tree.bytes[node]
            up = tree.up[node]
            children[up] += 1
            leaves[up] += leaves[node]
            saved[up] += saved[node]
    for node in order:
        up = tree.up[node]
        yield (node in border, border.get(node), border.get(up), tree.least[node], tree.depth[node],
               tree.least[up] if up >= 0 and up not in border else None, tree.n[node], children[node], leaves[node], saved[node],
               tree.bytes[node], tree.end.get(node) if node in border else tree.end.get(node, NOTHING), shard, None, None)
    for key, piece, text in pieces:
        yield (None, key, *[None] * 10, shard, piece, text)


def _tree_rows(seqs: DataFrame, shards: int) -> DataFrame:
    flat = seqs.select("conv_id", F.transform("seq", lambda x: x["id"]).alias("words"), F.transform("seq", lambda x: x["bytes"]).alias("sizes"))
    dealt = flat.repartitionByRange(shards, "words", "conv_id").sortWithinPartitions("words", "conv_id")

    def run(batches):
        def rows():
            for batch in batches:
                yield from zip(*(c.to_pylist() for c in batch.columns))

        out = []
        for row in shard_nodes(rows(), TaskContext.get().partitionId()):
            out.append(row)
            if len(out) >= 8192:
                yield _batch(out)
                out = []
        if out:
            yield _batch(out)

    return table(dealt.mapInArrow(run, ", ".join(f"{n} {t}" for n, t in COLUMNS.items())), "trie-nodes")


def _batch(rows):
    return pa.RecordBatch.from_arrays([pa.array(c, TYPES[t]) for c, t in zip(zip(*rows), COLUMNS.values())], names=list(COLUMNS))


def _list_digests(pieces: DataFrame) -> DataFrame:
    """key, ends: the digest of each border list, its pieces streamed in the order of their shards."""
    def run(batches):
        key, sha = None, None
        for batch in batches:
            out = []
            for at, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if at != key:
                    if key is not None:
                        out.append((key, sha.hexdigest()))
                    key, sha = at, hashlib.sha256(text.encode())
                else:
                    sha.update(b"," + text.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=["key", "list"])
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([sha.hexdigest()])], names=["key", "list"])

    return pieces.repartition("key").sortWithinPartitions("key", "shard", "piece").select("key", "ids").mapInArrow(run, "key binary, list string")


def _merged(rows: DataFrame) -> DataFrame:
    """Written: the border nodes of all shards, merged, with whole subtree sums."""
    parts = rows.where("border").groupBy("key").agg(
        F.max("parent_key").alias("parent_key"), F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")], F.max("bytes").alias("bytes"), F.max("ends").alias("ends"))
    parts = table(parts, "trie-border")
    kids = parts.where("parent_key is not null").groupBy(F.col("parent_key").alias("key")).agg(F.count("*").alias("kids"))
    lists = _list_digests(rows.where("ids is not null"))
    nodes = parts.join(kids, "key", "left").join(lists, "key", "left")
    children = F.col("n_children") + F.coalesce("kids", F.lit(0))
    nodes = table(nodes.select("key", "parent_key", "conv_id", "depth", "n_convs", children.alias("n_children"),
                               (F.col("n_leaves") + F.when(children == 0, 1).otherwise(0)).alias("n_leaves"),
                               (F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("bytes")).alias("saved_tokens"),
                               F.coalesce("ends", "list", F.lit(NOTHING)).alias("ends")), "trie-border")
    # sums over all nodes fewer than `reach` steps below; `far` is the node that many steps above
    sums, reach = nodes.select("key", F.col("parent_key").alias("far"), "n_leaves", "saved_tokens"), 1
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    while reach <= deepest:
        more = sums.where("far is not null").groupBy(F.col("far").alias("key")).agg(
            F.sum("n_leaves").alias("_l"), F.sum("saved_tokens").alias("_s"))
        farther = sums.select(F.col("key").alias("far"), F.col("far").alias("_f"))
        sums = table(sums.join(farther, "far", "left").join(more, "key", "left").select(
            "key", F.col("_f").alias("far"), (F.col("n_leaves") + F.coalesce("_l", F.lit(0))).alias("n_leaves"),
            (F.col("saved_tokens") + F.coalesce("_s", F.lit(0))).alias("saved_tokens")), "trie-sums")
        reach *= 2
    return table(nodes.drop("n_leaves", "saved_tokens").join(sums.drop("far"), "key"), "trie-border")


def prefix_trie(seqs: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """One row per node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``seqs`` has conv_id and seq. saved_tokens sums (members - 1) * bytes of the last text over the subtree; ends_sha256 digests
    the comma-joined ids of the members that end at the node.
    """
    seqs = table(seqs, "trie-rebuilt")
    turns = seqs.agg(F.sum(F.size("seq"))).first()[0] or 0
    least = int(seqs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = _tree_rows(seqs, max(least, -(-turns // shard_turns)))
    border = _merged(rows)
    own = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.col("ends").alias("ends_sha256")]
    parents = border.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("_up"))
    inner = rows.where("not border")
    far = inner.where("parent_key is null").select(*own)
    near = inner.where("parent_key is not null").drop("parent_conv_id").join(parents, "parent_key").withColumnRenamed("_up", "parent_conv_id").select(*own)
    edge = border.join(parents, "parent_key", "left").withColumnRenamed("_up", "parent_conv_id").select(*own)
    return far.unionByName(near).unionByName(edge)

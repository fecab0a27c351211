"""SimHash near-duplicates, joined by Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into three segments of at most 23 bits. The binary Golay code of length 23 is perfect: every
word lies within 3 bits of exactly one codeword. The codewords within 4 bits of a word are one (nearest at 0-2 bits) or six
(nearest at 3 bits), and two words that differ in at most 2 bits share one of them: the codeword nearest to a word between
them. Pigeonhole: two errors cannot touch all three segments, so a pair at distance 2 or less agrees in some segment
exactly and shares a codeword of the segment after it. (segment, its value, codeword index of the next segment) are the
join keys; pairs that meet are verified by their bit distance.

Keys with many fingerprints do not make pairs: their fingerprints meet on all words within 1 bit of them instead; those
that share such a word differ in at most 2 bits, and two at distance 2 or less always share one, so each is linked to
the smallest of its word, which gives the same components with a number of links in proportion to the fingerprints.

Texts without words (null, empty) have fingerprint zero and are linked like any other; equal rows share a fingerprint and
are never paired. Null ids get a component but never name one. An empty table gives an empty result; other columns are
not read. Ids may be structs: a caller that keeps one row of each group gives every row an id of its own.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, id_text, table

#: x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1, a generator of the Golay code.
GENERATOR = 0b110001110101
#: Lowest bit and width of the three segments.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: A key with more fingerprints than this links through shared words instead of pairs.
PAIR_LIMIT = 64
BITS = ((np.arange(256)[:, None] >> np.arange(7, -1, -1)) & 1).astype(np.int64)


def remainder(word: int) -> int:
    """word modulo the generator: zero exactly for codewords."""
    for shift in range(11, -1, -1):
        if word >> (shift + 11) & 1:
            word ^= GENERATOR << shift
    return word


@lru_cache(maxsize=1)
def decoder() -> tuple[np.ndarray, np.ndarray]:
    """For each of the 2048 remainders: six error patterns of at most 4 bits (the one repeated where there is one), and
    the remainder table of the upper 12 bits."""
    single = [remainder(1 << i) for i in range(23)]
    found: dict[int, list[int]] = {}
    for weight in range(5):
        for bits in combinations(range(23), weight):
            pattern, rest = sum(1 << b for b in bits), 0
            for b in bits:
                rest ^= single[b]
            if weight < 4 or found[rest][0].bit_count() == 3:
                found.setdefault(rest, []).append(pattern)
    errors = np.array([(found[r] * 6)[:6] for r in range(2048)], np.int64)
    return errors, np.array([remainder(u << 11) for u in range(4096)], np.int64)


def codewords(words: np.ndarray) -> np.ndarray:
    """(n, 6) indices of the codewords within 4 bits of each 23-bit word (repeats where there is only one)."""
    errors, upper = decoder()
    rest = upper[words >> 11] ^ (words & 2047)
    return (words[:, None] ^ errors[rest]) >> 11


def keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key): the distinct join keys of each fingerprint (uint64)."""
    parts = [((prints >> np.uint64(low)) & np.uint64((1 << width) - 1)).astype(np.int64) for low, width in SEGMENTS]
    near = [codewords(p) for p in parts]
    rows, out = [], []
    for i, exact in enumerate(parts):
        sorted_near = np.sort(near[(i + 1) % 3], axis=1)
        new = np.ones(sorted_near.shape, bool)
        new[:, 1:] = sorted_near[:, 1:] != sorted_near[:, :-1]
        r, k = np.nonzero(new)
        rows.append(r)
        out.append((i << 34) | (exact[r] << 12) | sorted_near[r, k])
    return np.concatenate(rows), np.concatenate(out)


def fingerprint(text: bytes, size: int = 3) -> int:
    """Majority bits over the XXH64 (seed 42) of all word shingles of an ASCII-lower-cased UTF-8 text."""
    import xxhash

    digest, words = xxhash.xxh64_digest, text.lower().split()
    if not words:
        return 0
    ones, n = np.zeros(64, np.int64), 0
    for at in range(0, max(1, len(words) - size + 1), 1 << 16):
        some = words[at:at + (1 << 16) + size - 1]
        shingles = [b" ".join(s) for s in zip(*(some[k:] for k in range(size)))] if len(words) >= size else [b" ".join(words)]
        hashes = np.frombuffer(b"".join([digest(s, 42) for s in shingles]), np.uint8).reshape(-1, 8)
        n += len(hashes)
        if len(hashes) < 200:
            ones += BITS[hashes].sum(axis=0).ravel()
        else:
            ones += np.concatenate([np.bincount(hashes[:, k], minlength=256) @ BITS for k in range(8)])
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(df: DataFrame, size: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, print (the fingerprint as a signed long)."""
    docs = id_text(df, id_col, text_col)

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                values = [fingerprint(x, size) for x in part.column(1).cast(pa.binary()).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.array(values, np.uint64).view(np.int64))],
                                                 names=["doc_id", "print"])

    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, print long")


def links(prints: DataFrame, distance: int = 2) -> DataFrame:
    """(a, b): links between distinct fingerprints (column print) whose components are those of all pairs within ``distance``.

    ``distance`` is 0, 1 or 2, what the code's keys guarantee.
    """
    if distance not in (0, 1, 2):
        raise ValueError("the keys cover distances of up to 2 bits")
    each = prints.select("print").distinct()

    def run(batches):
        for batch in batches:
            own = batch.column(0).to_numpy(zero_copy_only=False)
            rows, key = keys(own.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(own[rows])], names=["key", "print"])

    keyed = table(each.mapInArrow(run, "key long, print long"), "golay-keys")
    sizes = table(keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "golay-sizes")
    met = table(keyed.join(sizes, "key"), "golay-met")
    small = met.where(F.col("n") <= PAIR_LIMIT)
    pairs = (small.select("key", F.col("print").alias("a")).join(small.select("key", F.col("print").alias("b")), "key")
             .where((F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance))
             .select("a", "b").distinct())
    flips = [0] + [1 << b if b < 63 else -(1 << 63) for b in range(64)] if distance == 2 else [0]
    crowd = met.where(F.col("n") > PAIR_LIMIT).select("print").distinct()
    between = table(crowd.select("print", F.explode(F.array(*[F.col("print").bitwiseXOR(F.lit(f).cast("long")) for f in flips]))
                                 .alias("word")), "golay-between")
    lowest = table(between.groupBy("word").agg(F.min("print").alias("b"), F.count("*").alias("n")).where("n > 1").drop("n"),
                   "golay-lowest")
    stars = between.join(lowest, "word").where("print <> b").select(F.col("print").alias("a"), "b")
    if distance == 1:  # one step apart: the word is one of the two
        one = table(crowd.select("print", F.explode(F.array(*[F.col("print").bitwiseXOR(F.lit(1 << b if b < 63 else -(1 << 63)).cast("long"))
                                                              for b in range(64)])).alias("b")), "golay-one")
        stars = one.join(crowd.select(F.col("print").alias("b")), "b", "left_semi").select(F.col("print").alias("a"), "b")
    return pairs.unionByName(stars).distinct()


def near_duplicates(df: DataFrame, size: int = 3, distance: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable over links, itself included)."""
    docs = table(fingerprints(df, size, id_col, text_col), "prints")
    first = table(docs.groupBy("print").agg(F.min("doc_id").alias("first")), "print-first")
    found = table(components(links(first, distance), "a", "b"), "print-roots")
    rooted = table(first.join(found, first["print"] == found["node"], "left")
                   .select("print", "first", F.coalesce("root", "print").alias("root")), "print-rooted")
    lowest = table(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "print-lowest")
    named = table(rooted.join(lowest, "root").select("print", "component_id"), "print-named")
    return docs.join(named, "print").select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")

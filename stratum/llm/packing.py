"""Packing by concatenate and cut: one long stream of all documents' tokens, cut into windows of a fixed length.

First pass: encode every document once, write its ids and its place in its partition, and total each partition. A prefix
sum over these totals (one row per partition) gives every partition's global offset. Second pass: each document's global
position is known, so its pieces follow from the window borders, with no further shuffle. Only the last window can be
short; it is padded to the window length unless its length is a power of two.

A null text is empty: its only token is the closing id. A very long text is encoded piece by piece. Repeated rows are packed each; an empty table gives an empty
result; further columns are not read. Recomputed tasks cannot move a document: positions are read from the written pass.
"""

from __future__ import annotations

import re
import zlib
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe_tables import default_path, pieces, stretches, tables
from .common import id_text, table

# The split pattern of the byte-level vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Longer texts, and texts with code points that the two libraries may class differently, are split here, not by the pattern
#: of the tiktoken library (its matcher gives up on some hundred thousand blanks in a row).
SHORT = 100_000
MEMO = 200_000
#: The totals (one row of two numbers per partition) are broadcast up to this many rows, else joined.
MAX_BROADCAST_ROWS = 1_000_000


@lru_cache(maxsize=2)
def encoder(path: str):
    """text -> numpy ids; the vocabulary file's byte-level merges in the tiktoken library (ids are merge ranks)."""
    import tiktoken

    t = tables(path)
    ranks = {bytes(t.bytes_of[c] for c in token): i for token, i in t.vocab.items()}
    enc = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=t.special)

    split = pieces(path)
    cut = re.compile("|".join(map(re.escape, sorted(t.special, key=len, reverse=True)))) if t.special else None

    def by_piece(text: str):
        """The library's own pieces, one at a time: any length of white space, any code point."""
        for part in stretches(text):
            for piece in split.findall(part):
                known = short.get(piece)
                if known is None:
                    known = enc._encode_single_piece(piece)
                    if len(piece) < 30:
                        if len(short) > MEMO:
                            short.clear()
                        short[piece] = known
                yield known

    def encode(text: str) -> np.ndarray:
        if len(text) <= SHORT and split.plain(text):
            return np.array(enc.encode(text, allowed_special="all"), np.uint32)
        out, at = [], 0
        for m in cut.finditer(text) if cut else ():
            out += [*by_piece(text[at:m.start()]), [t.special[m.group()]]]
            at = m.end()
        return np.fromiter(chain.from_iterable(chain(out, by_piece(text[at:]))), np.uint32)

    short: dict[str, list[int]] = {}
    return encode


def encoded(df: DataFrame, path: str, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """First pass, written: doc_id, part, start (in the part), n, ids (little-endian; two bytes each where that does)."""
    docs = id_text(df, id_col, text_col)
    kind = "<u2" if max(tables(path).token) < 1 << 16 and end_id < 1 << 16 else "<u4"

    def run(batches):
        encode, part, start = encoder(path), TaskContext.get().partitionId(), 0
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = batch.slice(at, 256)
                ids = [np.append(encode(x), np.uint32(end_id)) for x in rows.column(1).to_pylist()]
                n = np.array([len(x) for x in ids], np.int64)
                starts = start + np.cumsum(n) - n
                start += int(n.sum())
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array(np.full(len(ids), part, np.int32)), pa.array(starts), pa.array(n),
                     pa.array([x.astype(kind).tobytes() for x in ids], pa.binary())],
                    names=["doc_id", "part", "start", "n", "ids"])

    kind_of_id = docs.schema["doc_id"].dataType.simpleString()
    return table(docs.mapInArrow(run, f"doc_id {kind_of_id}, part int, start long, n long, ids binary"), "packing")


def pack(df: DataFrame, window: int = 2048, end_id: int = 1, path: str | None = None, id_col: str = "doc_id",
         text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, sequence_length (padded).

    ``with_ids`` adds the piece's ids as an array (the packed training sequences themselves).
    """
    path = path or default_path("byte_bpe_50k.json")
    written = encoded(df, path, end_id, id_col, text_col)
    wide = 2 if max(tables(path).token) < 1 << 16 and end_id < 1 << 16 else 4
    totals = written.groupBy("part").agg(F.sum("n").alias("total"))
    over = Window.orderBy("part")  # one row per partition of the first pass
    places = table(totals.select("part", (F.sum("total").over(over) - F.col("total")).alias("base"),
                                 F.sum("total").over(Window.partitionBy()).alias("all")), "places")
    placed = written.join(F.broadcast(places) if places.count() <= MAX_BROADCAST_ROWS else places, "part")
    placed = placed.select("doc_id", "n", "ids", (F.col("base") + F.col("start")).alias("at"), "all")
    kind_of_id = written.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            rows, docs = [], []
            for i, (n, ids, at, end) in enumerate(zip(*(batch.column(k).to_pylist() for k in range(1, 5)))):
                ids = np.frombuffer(ids, f"<u{wide}").astype("<u4")
                cut = 0
                while cut < n:
                    sequence, offset = divmod(at + cut, window)
                    length = min(window - offset, n - cut)
                    own = ids[cut:cut + length]
                    last = min(window, end - sequence * window)
                    padded = last if last & (last - 1) == 0 else window
                    rows.append((cut, length, zlib.crc32(own.tobytes()), n, sequence, offset, padded, own if with_ids else None))
                    docs.append(i)
                    cut += length
            columns = [batch.column(0).take(pa.array(docs, pa.int64()))]
            columns += [pa.array([r[k] for r in rows], pa.int64()) for k in range(7)]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "sequence_length"]
            if with_ids:
                columns.append(pa.array([r[7] for r in rows], pa.list_(pa.int64())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return placed.mapInArrow(run, f"doc_id {kind_of_id}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
                             "offset long, sequence_length long" + (", ids array<long>" if with_ids else ""))

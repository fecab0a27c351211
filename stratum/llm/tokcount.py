"""Token counts by prefix dynamic programming: the exact token count of every prefix, from one pass over the text.

For byte-pair vocabularies the encoding of a prefix ends in exactly one token that agrees with the encoding before it:
``count[i] = count[i - len(t)] + 1`` for the one token ``t`` that ends at ``i``, encodes to itself and stays apart from
the last token of the prefix before (their joint bytes encode to just these two). The table of a piece (a word of the
split pattern) holds the count at each of its prefixes; a text's table is the running total over its pieces plus the
piece's own, so truncation and budget questions are look-ups.

A null text counts as empty (0 tokens, 0 bytes). Special strings inside a text are one token each, as in the tokenizers
library; letters and numbers are what the library takes for them. Very long texts are cut where every split pattern has a
border. Repeated rows are counted each; an empty table gives an empty result; further input columns are not read.
"""

from __future__ import annotations

from bisect import bisect_left
from itertools import accumulate
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .bpe_tables import default_path, pieces, splitter, stretches, tables
from .common import id_text

#: Pieces whose tables a worker remembers; it forgets all of them beyond this, which costs time only.
MEMO = 600_000
LONG = 200
ROWS = 512
TOTAL = itemgetter(-1)


class PrefixCounter:
    def __init__(self, path: str):
        self.t = tables(path)
        to_byte = self.t.bytes_of
        self.ids = {bytes(to_byte[c] for c in tok): tok for tok in self.t.vocab}
        self.tails = {b[i:] for b in self.ids for i in range(len(b))}
        self.pair: dict[tuple[bytes, bytes], bool] = {}
        self.memo: dict[str, bytes | list[int]] = {}
        self.split = pieces(path)
        self.special = self.t.special
        self.cut = splitter("|".join(sorted(map(_escape, self.special), key=len, reverse=True))) if self.special else None

    def apart(self, left: bytes, right: bytes) -> bool:
        """Do the two tokens, put together, encode to just these two? (An empty left: does the right encode to itself?)"""
        known = self.pair.get((left, right))
        if known is None:
            if len(self.pair) > 4 * MEMO:
                self.pair.clear()
            want = [self.ids[x] for x in (left, right) if x]
            known = self.pair[left, right] = self.t.merge([self.t.chars[b] for b in left + right]) == want
        return known

    def grow(self, piece: bytes, last: list, count: list, done: int) -> None:
        """Continue the tables from prefix length ``done``: last[i] and count[i] of piece[:i], for every i up to the end."""
        del last[done + 1:], count[done + 1:]
        tails, ids, pair, apart = self.tails, self.ids, self.pair, self.apart
        for i in range(done + 1, len(piece) + 1):
            fits, start = [], i - 1
            while start >= 0 and (tail := piece[start:i]) in tails:
                if tail in ids:
                    fits.append((start, tail))
                start -= 1
            for start, token in reversed(fits):
                known = pair.get((last[start], token))
                if known or known is None and apart(last[start], token):
                    last.append(token)
                    count.append(count[start] + 1)
                    break
            else:
                raise ValueError("the vocabulary cannot encode this text")

    def table(self, piece: bytes) -> list[int]:
        """count[i]: tokens of piece[:i], for every i."""
        last, count = [b""], [0]
        self.grow(piece, last, count, 0)
        return count

    def learn(self, pieces) -> None:
        """Tables of all these pieces: in sorted order each continues the table of the prefix it shares with the one before."""
        if len(self.memo) > MEMO:
            self.memo.clear()
        last, count, before = [b""], [0], b""
        for b, text in sorted((p.encode(), p) for p in pieces if p not in self.memo):
            done = 0
            for x, y in zip(b, before):
                if x != y:
                    break
                done += 1
            self.grow(b, last, count, done)
            before = b
            self.memo[text] = bytes(count) if count[-1] < 256 and len(count) <= LONG else count.copy()

    def piece(self, piece: str):
        """The table of one piece."""
        if piece not in self.memo:
            self.learn([piece])
        return self.memo[piece]

    def pieces(self, text: str):
        for part in stretches(text):
            yield from self.split.findall(part)

    def counts(self, pieces: list[str]) -> list[int]:
        self.learn(set(pieces))
        return list(map(TOTAL, map(self.memo.__getitem__, pieces)))

    def split_all(self, text: str) -> list[str]:
        return self.split.findall(text) if len(text) < 1 << 20 else list(self.pieces(text))

    def totals(self, texts: list[str], limit: int) -> tuple[list[int], list[int]]:
        """Tokens of each text, and characters of its longest prefix of at most ``limit`` tokens."""
        plain = [self.cut is None or self.cut.search(x) is None for x in texts]
        split = [self.split_all(x) if p else [] for x, p in zip(texts, plain)]
        self.learn({p for pieces in split for p in pieces})
        get, n, fit = self.memo.__getitem__, [], []
        for text, easy, pieces in zip(texts, plain, split):
            if easy:
                own = list(map(TOTAL, map(get, pieces)))
                n.append(sum(own))
                fit.append(len(text) if n[-1] <= limit else self._fit(pieces, own, limit))
        if not all(plain):
            hard = iter([(self.total(x), self.fits(x, limit)) for x, p in zip(texts, plain) if not p])
            easy = iter(zip(n, fit))
            n, fit = map(list, zip(*(next(easy if p else hard) for p in plain)))
        return n, fit

    def segments(self, text: str):
        """(plain text, special string after it or '') from left to right."""
        at = 0
        for m in self.cut.finditer(text) if self.cut else ():
            yield text[at:m.start()], m.group()
            at = m.end()
        yield text[at:], ""

    def total(self, text: str) -> int:
        return sum(sum(self.counts(self.split_all(plain))) + bool(special) for plain, special in self.segments(text))

    def prefixes(self, text: str) -> np.ndarray:
        """count[i]: tokens of text[:i] for every character position i of the whole text, exactly."""
        done = [np.zeros(1, np.int64)]
        for plain, special in self.segments(text):
            # positions inside a special string are ordinary text after what stands before it
            base, here = int(done[-1][-1]), self._plain(plain + special[:-1])
            done.append(base + here[1:])
            if special:
                done.append(np.array([base + here[len(plain)] + 1]))
        return np.concatenate(done)

    def _plain(self, text: str) -> np.ndarray:
        out, at, base = np.zeros(len(text) + 1, np.int64), 0, 0
        previous = ""
        for p in self.pieces(text):
            own = np.array(list(self.piece(p)))
            ends = np.cumsum([len(c.encode()) for c in p])
            out[at + 1:at + len(p) + 1] = base + own[ends]
            if len(p) == 3 and p in ("'re", "'ve", "'ll"):  # cut after its letter it is two pieces
                out[at + 2] = base + sum(self.counts([p[0], p[1]]))
            if previous and p[0].isspace():  # cut after the space that the next piece takes, the white space is one piece
                run = previous + p[0]
                out[at + 1] = base - self.piece(previous)[-1] + self.piece(run)[-1]
            base, at = base + int(own[-1]), at + len(p)
            previous = p if p.isspace() else ""
        return out

    def fits(self, text: str, limit: int) -> int:
        """Characters in the longest prefix of at most ``limit`` tokens, by its definition (any text)."""
        return int(np.flatnonzero(self.prefixes(text) <= limit)[-1])

    def _fit(self, pieces: list[str], counts: list[int], limit: int) -> int:
        """The same from the running totals and the table of the one piece in which they pass the limit."""
        running = list(accumulate(counts, initial=0))
        k = bisect_left(running, limit + 1) - 1
        low = max(0, k - 1)  # white space before that piece takes its first space along when cut there
        here = self._plain("".join(pieces[low:k + 1])) + running[low]
        return sum(map(len, pieces[:low])) + int(np.flatnonzero(here <= limit)[-1])


def _escape(text: str) -> str:
    import regex

    return regex.escape(text)


_counters: dict[str, PrefixCounter] = {}


def counter(path: str) -> PrefixCounter:
    """One per vocabulary and Python worker."""
    if path not in _counters:
        _counters[path] = PrefixCounter(path)
    return _counters[path]


def token_counts(df: DataFrame, limit: int = 512, path: str | None = None, id_col: str = "doc_id", text_col: str = "text",
                 every_prefix: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit, limit_chars (characters of the longest prefix of at most ``limit`` tokens).

    ``every_prefix`` adds prefix_tokens, an array with the count at each of the n + 1 character positions.
    """
    path = path or default_path("byte_bpe_50k.json")
    docs = id_text(df, id_col, text_col)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, n_bytes long, n_tokens long, over_limit boolean, limit_chars long"

    def run(batches):
        c = counter(path)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                texts = part.column(1).to_pylist()
                n, fit = c.totals(texts, limit)
                columns = [part.column(0), pa.array([len(x.encode()) for x in texts], pa.int64()), pa.array(n, pa.int64()),
                           pa.array([k > limit for k in n]), pa.array(fit, pa.int64())]
                names = ["doc_id", "n_bytes", "n_tokens", "over_limit", "limit_chars"]
                if every_prefix:
                    columns.append(pa.array([c.prefixes(x) for x in texts], pa.list_(pa.int64())))
                    names.append("prefix_tokens")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.mapInArrow(run, schema + (", prefix_tokens array<long>" if every_prefix else ""))

"""Byte-pair encoding and decoding with forced-boundary splitting, for vocabularies whose tokens end words with a mark.

Two neighbouring symbols that occur next to each other inside no vocabulary token can never be merged across: such a pair
is a certain cut. A word is cut at all of these pairs, the fragments are encoded independently (each distinct fragment
once) and their ids concatenated; words are certain cuts themselves. Decoding joins the tokens' texts with single spaces,
as the library does for a vocabulary without a decoder.

A null text is empty and has no ids. Special strings inside a text are one id each, as the library's default. Repeated
rows are encoded each, very long texts in stretches; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
import struct
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe_tables import SPACE, default_path, splitter, stretches, tables
from .common import id_text

# The word pattern in the vocabulary file, with its white space written out and letters first.
WORDS = rf"\p{{L}}+|\p{{N}}|'s|'t|'re|'ve|'m|'ll|'d|[^{SPACE}\p{{L}}\p{{N}}]+"
ASCII_WORDS = r"[a-z]+|[0-9]|'s|'t|'re|'ve|'m|'ll|'d|[^\t-\r a-z0-9]+"
#: Words and fragments a worker remembers; it forgets all of them beyond this, which costs time only.
MEMO = 800_000


def normalize(text: str) -> str:
    """NFC, then each character's own lower case (no rule that looks at neighbours, as for a final sigma)."""
    if text.isascii():
        return text.lower()
    return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


class Codec:
    def __init__(self, path: str):
        self.t, self.path = tables(path), path
        self.ascii, self.library = re.compile(ASCII_WORDS), None
        self.fine: set[str] = set()
        self.words, self.suffix = splitter(WORDS), self.t.suffix
        self.joined = {p for token in self.t.vocab for s in [self.symbols(token)] for p in zip(s, s[1:])}
        self.special = self.t.special
        self.cut = splitter("|".join(x.replace("|", r"\|") for x in self.special)) if self.special else None
        size = max(self.t.token) + 1
        self.text = [self.t.token.get(i, "") for i in range(size)]
        self.word_memo: dict[str, bytes] = {}
        self.fragment_memo: dict[tuple, list[int]] = {}

    def symbols(self, token: str) -> list[str]:
        """The characters of a token; the end mark belongs to the last one."""
        if self.suffix and token.endswith(self.suffix) and token != self.suffix:
            body = token[:-len(self.suffix)]
            return [*body[:-1], body[-1] + self.suffix]
        return list(token)

    def fragments(self, symbols: list[str]) -> list[list[str]]:
        """Cut wherever two neighbouring symbols are neighbours in no token."""
        out, start = [], 0
        for i, pair in enumerate(zip(symbols, symbols[1:]), 1):
            if pair not in self.joined:
                out.append(symbols[start:i])
                start = i
        return [*out, symbols[start:]]

    def fragment(self, symbols: list[str]) -> list[int]:
        key = tuple(symbols)
        known = self.fragment_memo.get(key)
        if known is None:
            if len(self.fragment_memo) > MEMO:
                self.fragment_memo.clear()
            known = [self.t.vocab[s] for s in (self.t.merge(symbols) if len(symbols) < 200 else self._long(symbols))]
            if len(key) < 200:
                self.fragment_memo[key] = known
        return known

    def _long(self, parts: list[str]) -> list[str]:
        """A very long fragment: each round merges all places of the lowest-ranked pair, from the left."""
        while True:
            rank, pair = min(((self.t.merges.get(p, 1 << 30), p) for p in set(zip(parts, parts[1:]))), default=(1 << 30, None))
            if rank == 1 << 30:
                return parts
            out, i = [], 0
            while i < len(parts):
                if i + 1 < len(parts) and (parts[i], parts[i + 1]) == pair:
                    out.append(parts[i] + parts[i + 1])
                    i += 2
                else:
                    out.append(parts[i])
                    i += 1
            parts = out

    def word(self, word: str) -> bytes:
        """Ids of a normalised word, little-endian 32-bit."""
        chars = [self.t.chars[b] for b in word.encode()]
        chars[-1] += self.suffix
        found = [i for f in self.fragments(chars) for i in self.fragment(f)]
        ids = struct.pack(f"<{len(found)}I", *found)
        if len(word) < 200:
            self.word_memo[word] = ids
        return ids

    def split(self, text: str) -> list[str]:
        """The normalised words. Code points newer than Python's Unicode are left to the library's normaliser and splitter."""
        if text.isascii():
            return self.ascii.findall(text.lower())
        new = set(text) - self.fine
        # what Python's Unicode does not know yet; U+1DF6 changed its combining class
        unknown = {c for c in new if unicodedata.category(c) == "Cn" or c == "\u1df6"}
        self.fine |= new - unknown
        if not unknown:
            return self.words.findall(normalize(text))
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_file(self.path)
        found = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
        return [bytes(map(self.t.bytes_of.__getitem__, w)).decode() for w, _ in found]

    def plain(self, text: str) -> bytes:
        out, memo, word = [], self.word_memo.get, self.word
        for part in stretches(text):
            if len(self.word_memo) > MEMO:
                self.word_memo.clear()
            out += [memo(w) or word(w) for w in self.split(part)]
        return b"".join(out)

    def encode(self, text: str) -> bytes:
        """Ids of the text, little-endian 32-bit."""
        if self.cut is None or "<|" not in text:
            return self.plain(text)
        out, at = [], 0
        for m in self.cut.finditer(text):
            out += [self.plain(text[at:m.start()]), np.uint32(self.special[m.group()]).tobytes()]
            at = m.end()
        return b"".join([*out, self.plain(text[at:])])

    def decode(self, ids) -> str:
        return " ".join(map(self.text.__getitem__, ids))


_codecs: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """One per vocabulary and Python worker."""
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


def _map(df: DataFrame, schema: str, columns):
    """One output row per input row: doc_id and what ``columns`` makes of a slice of values."""
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                made = columns(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), *made.values()], names=["doc_id", *made])

    return df.mapInArrow(run, f"doc_id {df.schema['doc_id'].dataType.simpleString()}, {schema}")


def encode(df: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids (binary, little-endian 32-bit), n_tokens."""
    path = path or default_path("word_bpe_49k.json")

    def columns(texts):
        ids = [codec(path).encode(x) for x in texts]
        return {"ids": pa.array(ids, pa.binary()), "n_tokens": pa.array([len(x) // 4 for x in ids], pa.int64())}

    return _map(id_text(df, id_col, text_col), "ids binary, n_tokens long", columns)


def decode(df: DataFrame, path: str | None = None, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id, text: the tokens of ``ids_col`` (binary as ``encode`` gives it; null: none) as the library decodes them."""
    path = path or default_path("word_bpe_49k.json")

    def columns(values):
        c = codec(path)
        return {"text": pa.array([c.decode(np.frombuffer(x, "<u4").tolist()) for x in values], pa.string())}

    return _map(df.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(ids_col), F.lit(b"")).alias("ids")), "text string", columns)


def round_trip(df: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode, then decode: doc_id, n_tokens, ids_sha256, decoded_sha256 in one pass."""
    path = path or default_path("word_bpe_49k.json")

    def columns(texts):
        c = codec(path)
        ids = [c.encode(x) for x in texts]
        back = [c.decode(np.frombuffer(x, "<u4").tolist()).encode() for x in ids]
        return {"n_tokens": pa.array([len(x) // 4 for x in ids], pa.int64()),
                "ids_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in ids]),
                "decoded_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in back])}

    return _map(id_text(df, id_col, text_col), "n_tokens long, ids_sha256 string, decoded_sha256 string", columns)

"""Vocabulary files of byte-pair tokenizers as plain tables, shared by the token operators."""

from __future__ import annotations

import json
import re
import unicodedata
from functools import lru_cache


def byte_chars() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves, the others follow from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return {b: chr(b) if b in plain else chr(next(rest)) for b in range(256)}


class Tables:
    """``vocab``: token text to id; ``merges``: (left, right) to rank; ``special``: strings that stand for one id."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.merges = {tuple(m.split(" ") if isinstance(m, str) else m): i for i, m in enumerate(model["merges"])}
        self.suffix: str = model.get("end_of_word_suffix") or ""
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", []) if t["special"]}
        self.token = {i: t for t, i in {**self.vocab, **self.special}.items()}
        self.chars = byte_chars()
        self.bytes_of = {c: b for b, c in self.chars.items()}

    def merge(self, parts: list[str]) -> list[str]:
        """Byte-pair encoding of a short list of symbols: the lowest-ranked adjacent pair first, leftmost on a tie."""
        rank, none = self.merges.get, 1 << 30
        parts, ranks = list(parts), [rank(p, none) for p in zip(parts, parts[1:])]
        while ranks and (low := min(ranks)) < none:
            i = ranks.index(low)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del ranks[i]
            if i:
                ranks[i - 1] = rank((parts[i - 1], parts[i]), none)
            if i < len(ranks):
                ranks[i] = rank((parts[i], parts[i + 1]), none)
        return parts


@lru_cache(maxsize=4)
def tables(path: str) -> Tables:
    """Loaded once in each Python worker."""
    return Tables(path)


def default_path(name: str) -> str:
    """Where the installed public vocabulary files lie; every operator takes another path as a parameter."""
    import public_tokenizers

    return public_tokenizers.path(name)


# The library's split pattern of byte-level tokenizers, and its white space (Unicode White_Space). Alternatives
# that begin with different characters stand in the order of their frequency.
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
BYTE_LEVEL = (rf" ?\p{{L}}+| ?\p{{N}}+|'s|'t|'re|'ve|'m|'ll|'d| ?[^{SPACE}\p{{L}}\p{{N}}]+"
              rf"|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
#: The same where all characters are ASCII, for Python's own, faster matcher.
ASCII_LEVEL = r" ?[A-Za-z]+| ?[0-9]+|'s|'t|'re|'ve|'m|'ll|'d| ?[^\t-\r A-Za-z0-9]+|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+"


@lru_cache(maxsize=4)
def splitter(pattern: str):
    import regex

    return regex.compile(pattern, regex.V0)


def stretches(text: str, size: int = 1 << 20):
    """Cut a very long text before single spaces between two letters, where every split pattern here has a border."""
    if len(text) <= size:
        yield text
        return
    cut, start = splitter(r"(?<=\p{L}) (?=\p{L})"), 0
    while start < len(text):
        m = cut.search(text, start + size)
        end = m.start() if m else len(text)
        yield text[start:end]
        start = end


class Pieces:
    """Pieces of the byte-level split pattern as the tokenizers library cuts them.

    The library's Unicode can be older or newer than that of ``regex``: it is asked once for every code point beyond ASCII
    whether it takes it for a letter or a number, and the pattern says so where ``regex`` would not.
    """

    def __init__(self, path: str):
        self.path, self.asked, self.pattern = path, set(), splitter(BYTE_LEVEL)
        self.more: dict[str, set[str]] = {"L": set(), "N": set()}
        self.less: dict[str, set[str]] = {"L": set(), "N": set()}
        self.ascii = re.compile(ASCII_LEVEL)
        self.odd: set[str] = set()
        self.cut = None

    def ask(self, text: str) -> None:
        """Learn the classes of the text's code points."""
        new = {c for c in set(text) - self.asked if not c.isascii()}
        if not new:
            return
        if self.cut is None:
            from tokenizers import Tokenizer

            self.cut = Tokenizer.from_file(self.path).pre_tokenizer.pre_tokenize_str
        before = len(self.odd)
        for c in new:
            for kind, like in (("L", "a"), ("N", "1")):
                library, own = len(self.cut(like + c)) == 1, bool(splitter(rf"\p{{{kind}}}").match(c))
                if library != own:
                    (self.more if library else self.less)[kind].add(c)
                    self.odd.add(c)
        self.asked |= new
        if len(self.odd) > before:
            import regex

            def members(kind):
                some, none = ("".join(map(regex.escape, sorted(x[kind]))) for x in (self.more, self.less))
                return f"[[\\p{{{kind}}}{some}]" + (f"--[{none}]]" if none else "]")

            letters, numbers = members("L"), members("N")
            space = rf"[{SPACE}]"
            other = rf"[^{SPACE}{letters}{numbers}]"
            self.pattern = regex.compile(rf" ?{letters}+| ?{numbers}+|'s|'t|'re|'ve|'m|'ll|'d| ?{other}+|{space}+(?![^{SPACE}])|{space}+", regex.V1)

    def findall(self, text: str) -> list[str]:
        if text.isascii():
            return self.ascii.findall(text)
        self.ask(text)
        return self.pattern.findall(text)

    def plain(self, text: str) -> bool:
        """Are all code points assigned and in the classes that every Unicode of the last years gives them?"""
        if text.isascii():
            return True
        new = set(text) - self.asked
        self.ask(text)
        self.odd |= {c for c in new if unicodedata.category(c) == "Cn"}
        return not self.odd or self.odd.isdisjoint(text)


@lru_cache(maxsize=4)
def pieces(path: str) -> Pieces:
    """One per vocabulary and Python worker."""
    return Pieces(path)

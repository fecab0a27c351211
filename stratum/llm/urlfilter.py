"""URL filter lists: a trie over reversed host labels and path segments, longest match wins between allow and block.

A rule is (verdict, host, path). It fits a URL whose host is the rule's host or a subdomain of it and whose path starts
with the rule's path. Of several fitting rules the one with the longest host-plus-path text wins; of equally long ones a
block entry, then the longest host. Hosts are compared in lower case (A-Z). A URL that is null or has no ``://`` has an
empty host and path and fits nothing; with no fitting rule the verdict is ``default``. Repeated rows are judged row by row; empty tables give empty results; extra columns are ignored; texts of
any length are read whole (``filter_urls_joined`` makes a row for each pair of a host's suffix and a path's folder).
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "host string, path string, rule string, verdict string"
#: Text of the rules that one trie may hold; it is measured before rules are fetched.
MAX_TRIE_BYTES = 64 << 20


def parts(url: str | None) -> tuple[str, str]:
    """(host, path) of a URL text."""
    at = -1 if url is None else url.find("://")
    if at < 0:
        return "", ""
    rest = url[at + 3:]
    ends = [i for i in (rest.find("?"), rest.find("#")) if i >= 0]
    rest = rest[:min(ends)] if ends else rest
    slash = rest.find("/")
    host, path = (rest, "") if slash < 0 else (rest[:slash], rest[slash:])
    return host.translate(ASCII_LOWER), path


class Trie:
    """Host labels from the right, then full path segments; at a node, ``ends`` holds the rules' last, partial segments."""

    def __init__(self, rules):
        self.root = {"hosts": {}, "paths": None}
        for verdict, host, path in sorted(rules, key=lambda r: r[0] == "block"):  # block last: it overwrites a tie
            node, host = self.root, host.translate(ASCII_LOWER)
            for label in reversed(host.split(".")):
                node = node["hosts"].setdefault(label, {"hosts": {}, "paths": None})
            at = node["paths"] = node["paths"] or {"next": {}, "ends": {}}
            *full, last = path.split("/")
            for segment in full:
                at = at["next"].setdefault(segment, {"next": {}, "ends": {}})
            at["ends"][last] = (len(host) + len(path), verdict == "block", len(host), host + path, verdict)

    def match(self, host: str, path: str):
        """The winning rule as (length, is_block, length of its host, text, verdict), or None."""
        best, node, segments = None, self.root, path.split("/")
        for label in reversed(host.split(".")):
            node = node["hosts"].get(label)
            if node is None:
                break
            at = node["paths"]
            for segment in segments:
                if at is None:
                    break
                for size in range(min(len(segment), max(map(len, at["ends"]), default=-1)) + 1):
                    hit = at["ends"].get(segment[:size])
                    if hit and (best is None or hit[:3] > best[:3]):
                        best = hit
                at = at["next"].get(segment)
        return best


def _judge(trie, default: str):
    """``trie``: a broadcast Trie."""
    @F.pandas_udf(SCHEMA)
    def judge(urls: pd.Series) -> pd.DataFrame:
        rows = []
        for url in urls:
            host, path = parts(url)
            hit = trie.value.match(host, path)
            rows.append((host, path, *(hit[3:] if hit else (None, default))))
        return pd.DataFrame(rows, columns=["host", "path", "rule", "verdict"])

    return judge


def filter_urls(df: DataFrame, rules, id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """Judge every row's URL. ``rules``: a list of (verdict, host, path), or a DataFrame with those columns.

    The trie is broadcast. A DataFrame of rules with more text than ``MAX_TRIE_BYTES`` is refused: call ``filter_urls_joined``.
    """
    if isinstance(rules, DataFrame):
        size = rules.agg(F.sum(F.length(F.concat("host", "path")) + 64)).first()[0] or 0
        if size > MAX_TRIE_BYTES:
            raise ValueError(f"{size} bytes of rules do not fit into one trie: use filter_urls_joined")
        rules = [(r.verdict, r.host, r.path) for r in rules.select("verdict", "host", "path").collect()]
    trie = df.sparkSession.sparkContext.broadcast(Trie(rules))
    judged = df.select(F.col(id_col), _judge(trie, default)(F.col(url_col).cast("string")).alias("_j"))
    return judged.select(id_col, "_j.*")


def filter_urls_joined(df: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """The same rows for rule tables of any size: each distinct URL meets the rules by equi-join on (host suffix, full segments)."""
    lower = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    urls = df.select(F.col(url_col).cast("string").alias("_u")).distinct()
    after = F.when(F.instr("_u", "://") > 0, F.expr("substring(_u, instr(_u, '://') + 3)")).otherwise("")
    urls = urls.withColumn("_rest", F.regexp_extract(after, "^[^?#]*", 0)).select(
        "_u", F.translate(F.regexp_extract("_rest", "^[^/]*", 0), *lower).alias("host"),
        F.when(F.instr("_rest", "/") > 0, F.expr("substring(_rest, instr(_rest, '/'))")).otherwise("").alias("path"))
    labels, segments = F.split("host", "\\."), F.split("path", "/")
    probes = (urls.withColumn("_s", F.explode(F.transform(F.sequence(F.lit(1), F.size(labels)),
                                                          lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))))
              .withColumn("_k", F.explode(F.sequence(F.lit(0), F.size(segments) - 1)))
              .select("_u", "path", "_s", F.array_join(F.slice(segments, F.lit(1), F.col("_k")), "/").alias("_d"), "_k"))
    folder = F.split(F.col("path"), "/")
    host = F.translate("host", *lower)
    keyed = rules.select(host.alias("_s"),
                         (F.size(folder) - 1).alias("_k"),
                         F.array_join(F.slice(folder, F.lit(1), F.size(folder) - 1), "/").alias("_d"),
                         F.col("path").alias("_rp"), F.concat(host, "path").alias("rule"), "verdict")
    best = (probes.join(keyed, ["_s", "_d", "_k"]).where(F.col("path").startswith(F.col("_rp")))
            .groupBy("_u").agg(F.max(F.struct(F.length("rule").alias("n"), (F.col("verdict") == "block").alias("b"),
                                              F.length("_s").alias("h"), "rule", "verdict")).alias("_b")))
    judged = urls.join(best, "_u", "left").select(
        F.col("_u").alias("_url"), "host", "path", "_b.rule", F.coalesce("_b.verdict", F.lit(default)).alias("verdict"))
    return (df.select(F.col(id_col), F.col(url_col).cast("string").alias("_u2"))
            .join(judged, F.col("_u2").eqNullSafe(F.col("_url")), "left").select(id_col, "host", "path", "rule", "verdict"))

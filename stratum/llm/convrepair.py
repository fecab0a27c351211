"""Conversation structure repair: the cheapest edits to a legal turn order, by a rank-convergence parallel Viterbi search.

A conversation is legal when its role initials read ``(s?(ua)+)?``. Each row is kept (0), given the role user or assistant (3)
or deleted (4; blank and duplicate rows must be), and empty user or assistant rows may be inserted anywhere (3); a truncated
row that stays costs 3 more. Of the cheapest edits the audit, one letter an edit (Delete, Insert, Keep, Rerole), is the
ASCII-least.

1. Rows are sorted by range over (conversation, turn, digest of role and text) without their texts and cut into chunks of at
   most ``chunk_rows`` one-byte codes, so that a long conversation lies in many tasks.
2. Every chunk computes its backward costs (a vector over the four places of the pattern) at once: the last chunk of a
   conversation from the true end costs, the others from a speculative vector. Fix-up passes rerun a chunk with the vector its
   successor found, from its end until that vector differs from the one before by a constant only, since all earlier ones do
   then too; they end when no chunk starts from a vector other than its successor's. That takes few passes where a chunk's rows
   settle the phase of the pattern, at worst (rows of one role throughout) one a chunk of the longest conversation. Vectors are stored less their first
   entry; the sum of what was taken off is the cost.
3. With the stitched vectors each chunk traces the least audit from each place it may be entered in; composing these maps in
   doubling steps names the place, and so the audit.
4. The texts are shuffled once, by conversation and in order, the audit chunks between them, and edited as a stream.

Null roles and texts count as one space. Rows of one turn are ordered by digest. A null id is a conversation of its own; a
role without a first letter s, u or a (an empty one too) cannot be kept. Repeated rows are duplicates. Empty tables give empty
results. Very long texts pass through one task whole; no other step reads them. Only the four named columns are read.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import table

SPACES = " \t\n\x0b\x0c\r"
#: Places in the pattern: at the start, after s, after u, after a. STEP: where the only role that may be written leads.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
STEP = (AFTER_U, AFTER_U, AFTER_A, AFTER_U)
#: Where a kept row of class s, u, a, other leads from each place (-1: not allowed).
KEEP = ((AFTER_S, AFTER_U, -1, -1), (-1, AFTER_U, -1, -1), (-1, -1, AFTER_A, -1), (-1, AFTER_U, -1, -1))
OK, BLANK, DUPLICATE, TRUNCATED = range(4)
LEGAL_PAIRS = {(0, 1), (1, 2), (2, 1)}
REROLE, DELETE, INSERT, CUT = 3, 4, 3, 3
END = bytes([128, 128 + 2 * INSERT, 128 + INSERT, 128])
ANY = bytes([128] * 4)


@lru_cache(maxsize=None)
def step(code: int, after: bytes) -> tuple[bytes, int, tuple]:
    """One row: costs after it -> (costs before it less the first, that first, (letters, place after) from each place)."""
    role, fault = code & 3, code >> 2
    w = [x - 128 for x in after]
    extra = CUT if fault == TRUNCATED else 0

    def edits(x):
        yield "D", DELETE + w[x], x
        if fault in (OK, TRUNCATED):
            if KEEP[x][role] >= 0:
                yield "K", extra + w[KEEP[x][role]], KEEP[x][role]
            yield "R", REROLE + extra + w[STEP[x]], STEP[x]

    row = [min(cost for _, cost, _ in edits(x)) for x in range(4)]
    v = [min(row[x], INSERT + row[STEP[x]], 2 * INSERT + row[STEP[STEP[x]]]) for x in range(4)]
    moves = []
    for x in range(4):
        letters = ""
        while True:
            cheapest = {letter: to for letter, cost, to in edits(x) if cost == v[x]}
            if "D" in cheapest or v[x] != INSERT + v[STEP[x]]:
                letter = min(cheapest)
                moves.append((letters + letter, cheapest[letter]))
                break
            letters, x = letters + "I", STEP[x]
    return bytes(128 + x - v[0] for x in v), v[0], tuple(moves)


def sweep(codes: bytes, right: bytes, old: tuple[bytes, bytes, int] | None = None) -> tuple[bytes, int]:
    """(costs before the chunk, constant taken off) from the costs after it; ``old`` = (right, left, constant) of the pass before."""
    total, known = 0, old and old[0]
    undone = old[2] if old else 0
    for code in reversed(codes):
        if known == right:  # parallel from here on
            return old[1], total + undone
        right, off, _ = step(code, right)
        total += off
        if known:
            known, off, _ = step(code, known)
            undone -= off
    return right, total


def trace(codes: bytes, right: bytes, place: int, last: bool) -> tuple[str, int]:
    """(audit, place after the chunk) when the chunk is entered in ``place``."""
    moves = []
    for code in reversed(codes):
        right, _, own = step(code, right)
        moves.append(own)
    out = []
    for own in reversed(moves):
        letters, place = own[place]
        out.append(letters)
    if last:
        out.append({START: "", AFTER_S: "II", AFTER_U: "I", AFTER_A: ""}[place])
    return "".join(out), place


def _filled(c) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(" "))


def damage(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows damaged by crc32(``conv:turn``) % 20 (0 drop, 1 empty, 2 no ``.!?``, 3 twice, 4 user); nulls are one space."""
    kind = F.crc32(F.concat_ws(":", _filled(conv), _filled(turn)).cast("binary")) % 20
    rows = df.select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), _filled(role).alias("role"), _filled(text).alias("text"),
                     kind.alias("kind"))
    rows = rows.where("kind <> 0").withColumn("_copy", F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    return rows.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
                       F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"))


def _key(c: str) -> Column:
    """A key that is never null: null ids are a conversation of their own."""
    return F.coalesce(F.concat(F.lit("#"), F.col(c).cast("string")), F.lit(""))


def _rows(df: DataFrame) -> DataFrame:
    rows = df.select(_key("conv_id").alias("key"), "turn", _filled("role").alias("role"), _filled("text").alias("text"))
    return rows.withColumn("digest", F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"))))


def chunks(df: DataFrame, chunk_rows: int) -> DataFrame:
    """Written: key, k (chunk of the conversation), m (its chunks), codes, first row's turn and digest, fault counts, illegal pairs."""
    body = F.rtrim(F.col("text"), F.lit(SPACES))
    initial = F.substring("role", 1, 1)
    role = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    own = (F.when(body == "", BLANK).when(~F.substring(body, -1, 1).isin(".", "!", "?"), TRUNCATED).otherwise(OK))
    narrow = table(_rows(df).select("key", "turn", "digest", role.cast("int").alias("role"), own.cast("int").alias("fault")), "repair-rows")
    # turns start below every number for null, so that the first of equal rows is a plain minimum
    place = F.struct(F.col("turn").isNotNull().alias("told"), F.col("turn").alias("turn"))
    first = narrow.groupBy("key", "digest").agg(F.min(place).alias("first"), F.count("*").alias("same")).where("same > 1").drop("same")
    marked = narrow.join(first, ["key", "digest"], "left").select(
        "key", "turn", "digest", "role", "fault", F.coalesce(place > F.col("first"), F.lit(False)).alias("seen"))
    ordered = marked.repartitionByRange("key", F.col("turn").asc_nulls_first(), "digest").sortWithinPartitions(
        "key", F.col("turn").asc_nulls_first(), "digest")
    turn_type = df.schema["turn"].dataType.simpleString()

    def run(batches):
        part, seq, state = TaskContext.get().partitionId(), 0, None

        def close(s):
            counts = [sum(1 for c in s["codes"] if c >> 2 == f) for f in (BLANK, DUPLICATE, TRUNCATED)]
            classes = [c & 3 for c in s["codes"]]
            return (s["key"], part, s["seq"], bytes(s["codes"]), s["turn"], s["digest"], *counts,
                    sum(p not in LEGAL_PAIRS for p in zip(classes, classes[1:])), classes[0], classes[-1])

        before = None
        for batch in batches:
            out = []
            for key, turn, digest, role, fault, seen in zip(*(c.to_pylist() for c in batch.columns)):
                if state is None or state["key"] != key or len(state["codes"]) >= chunk_rows:
                    if state is not None:
                        out.append(close(state))
                        seq += 1
                    state = {"key": key, "seq": seq, "turn": turn, "digest": digest, "codes": bytearray()}
                if fault != BLANK and (seen or (key, turn, digest) == before):
                    fault = DUPLICATE
                before = (key, turn, digest)
                state["codes"].append(role | fault << 2)
            if out:
                yield _batch(out)
        if state is not None:
            yield _batch([close(state)])

    names = ["key", "part", "seq", "codes", "turn", "digest", "blank", "duplicate", "truncated", "illegal", "first_role", "last_role"]
    arrow_turn = _arrow(df.select("turn"))
    types = [pa.string(), pa.int32(), pa.int64(), pa.binary(), arrow_turn, pa.binary(), *[pa.int64()] * 4, pa.int32(), pa.int32()]

    def _batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    made = table(ordered.mapInArrow(run, f"key string, part int, seq long, codes binary, turn {turn_type}, digest binary, blank long, "
                                    "duplicate long, truncated long, illegal long, first_role int, last_role int"), "repair-chunks")
    over = Window.partitionBy("key").orderBy("part", "seq")  # one row per chunk
    nearby = F.lead("first_role").over(over)
    legal = F.when(nearby.isNull(), True).otherwise(F.concat("last_role", nearby).isin("01", "12", "21"))
    return table(made.select("key", (F.row_number().over(over) - 1).alias("k"), F.count("*").over(Window.partitionBy("key")).cast("int").alias("m"),
                             "codes", "turn", "digest", "blank", "duplicate", "truncated",
                             (F.col("illegal") + F.when(legal, 0).otherwise(1)).alias("illegal")), "repair-chunks")


def _arrow(df: DataFrame):
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema[0].dataType)


def _swept(df: DataFrame) -> DataFrame:
    """Columns right, and old_right, left, total of the pass before (null in the first): left and total anew."""
    schema = df.drop("old_right").schema

    def run(batches):
        for batch in batches:
            at = {n: i for i, n in enumerate(batch.schema.names)}
            codes, right, old, left, total = (batch.column(at[n]).to_pylist() for n in ("codes", "right", "old_right", "left", "total"))
            new = [sweep(c, r, None if o is None else (o, l, t)) for c, r, o, l, t in zip(codes, right, old, left, total)]
            cols = {n: batch.column(i) for n, i in at.items()}
            cols["left"], cols["total"] = pa.array([x for x, _ in new], pa.binary()), pa.array([t for _, t in new], pa.int64())
            yield pa.RecordBatch.from_arrays([cols[n] for n in schema.names], names=schema.names)

    return df.mapInArrow(run, schema)


def converge(made: DataFrame) -> tuple[DataFrame, int]:
    """Chunks with their final costs after (right) and before (left) them and the constant (total); and the number of fix-up passes."""
    lit = lambda b: F.lit(bytearray(b))
    start = made.select("key", "k", "m", "codes", F.when(F.col("k") == F.col("m") - 1, lit(END)).otherwise(lit(ANY)).alias("right"),
                        F.lit(None).cast("binary").alias("left"), F.lit(None).cast("long").alias("total"), F.lit(None).cast("binary").alias("old_right"))
    state, passes = table(_swept(start), "repair-costs"), 0
    single, state = state.where("m = 1"), state.where("m > 1")
    while True:
        following = state.select("key", (F.col("k") - 1).alias("k"), F.col("left").alias("new"))
        joined = state.join(following, ["key", "k"], "left").withColumn("new", F.coalesce("new", "right"))
        if joined.where("new <> right").limit(1).count() == 0:
            return single.unionByName(state), passes
        rerun = joined.select("key", "k", "m", "codes", F.col("new").alias("right"), "left", "total", F.col("right").alias("old_right"))
        state, passes = table(_swept(rerun), "repair-costs"), passes + 1


def audits(state: DataFrame) -> DataFrame:
    """Written: key, k, total, audit of each chunk."""
    def run(batches):
        for batch in batches:
            codes, right, k, m = (batch.column(i).to_pylist() for i in (2, 3, 1, 4))
            made = [[trace(c, r, x, j == n - 1) for x in (range(4) if j else (START,))] for c, r, j, n in zip(codes, right, k, m)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(4), batch.column(5), pa.array([[a for a, _ in t] for t in made], pa.list_(pa.string())),
                 pa.array([[p for _, p in t] for t in made], pa.list_(pa.int32()))], names=["key", "k", "m", "total", "audits", "exits"])

    traced = table(state.select("key", "k", "codes", "right", "m", "total").mapInArrow(
        run, "key string, k int, m int, total long, audits array<string>, exits array<int>"), "repair-traces")
    maps = traced.where("m > 1").select("key", "k", "exits")
    longest = traced.agg(F.max("m")).first()[0] or 1
    reach = 1
    while reach < longest:  # exits of chunks (k - reach, k] in one map, doubled
        before = maps.select("key", (F.col("k") + reach).alias("k"), F.col("exits").alias("_b"))
        joined = maps.join(before, ["key", "k"], "left")
        maps = table(joined.select("key", "k", F.when(F.col("_b").isNull(), F.col("exits")).otherwise(
            F.transform("_b", lambda x: F.col("exits")[x])).alias("exits")), "repair-maps")
        reach *= 2
    entry = maps.select("key", (F.col("k") + 1).alias("k"), F.col("exits")[0].alias("entry"))
    return table(traced.join(entry, ["key", "k"], "left").select(
        "key", "k", "total", F.col("audits")[F.coalesce("entry", F.lit(START))].alias("audit")), "repair-audits")


def _replay(df: DataFrame, made: DataFrame, audit: DataFrame, run, schema: str) -> DataFrame:
    """``run`` over the rows of whole conversations in order, each chunk's audit before its first row."""
    kind = df.schema["turn"].dataType.simpleString()
    notes = audit.join(made.select("key", "k", "turn", "digest"), ["key", "k"]).select(
        "key", "turn", "digest", F.lit(0).alias("kind"), "k", F.lit("").alias("role"), F.col("audit").alias("text"))
    rows = _rows(df).select("key", F.col("turn").cast(kind).alias("turn"), "digest", F.lit(1).alias("kind"), F.lit(0).alias("k"), "role", "text")
    both = notes.unionByName(rows).repartition("key").sortWithinPartitions("key", F.col("turn").asc_nulls_first(), "digest", "kind", "k")
    return both.select("key", "kind", "role", "text").mapInArrow(run, schema)


def _edited(batches):
    """(key, None) at the start of each conversation, then its repaired rows (key, (edit, role, text)), as a stream."""
    key, letters, place = None, [], START

    def inserted():
        nonlocal place
        role = "assistant" if place == AFTER_U else "user"
        place = STEP[place]
        return key, ("I", role, "")

    for batch in batches:
        for at, kind, role, text in zip(*(c.to_pylist() for c in batch.columns)):
            if at != key:
                while letters:
                    letters.pop()
                    yield inserted()
                key, place = at, START
                yield key, None
            if kind == 0:
                letters[:0] = reversed(text)
                continue
            while letters[-1] == "I":
                letters.pop()
                yield inserted()
            letter = letters.pop()
            if letter == "R":
                role = "assistant" if place == AFTER_U else "user"
            if letter != "D":
                place = STEP[place] if letter == "R" else KEEP[place]["sua".index(role[0])]
                yield key, (letter, role, text)
    while letters:
        letters.pop()
        yield inserted()


def _digests(batches):
    key, sha, first, out = None, None, True, []
    for at, row in _edited(batches):
        if row is None:
            if key is not None:
                out.append((key, sha.hexdigest()))
                if len(out) >= 4096:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=["key", "sha"])
                    out = []
            key, sha, first = at, hashlib.sha256(), True
        else:
            sha.update(("" if first else "\n").encode() + row[1].encode() + b":" + row[2].encode())
            first = False
    if key is not None:
        out.append((key, sha.hexdigest()))
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=["key", "sha"])


def _turns(batches):
    out, place = [], 0
    for key, row in _edited(batches):
        place = 0 if row is None else place + 1
        if row:
            out.append((key, place - 1, *row))
        if len(out) >= 512:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=["key", "place", "edit", "role", "text"])
            out = []
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=["key", "place", "edit", "role", "text"])


def repaired_turns(df: DataFrame, chunk_rows: int = 256) -> DataFrame:
    """The repaired conversations themselves: conv_id, place, edit (K, R or I), role, text."""
    made = chunks(df, chunk_rows)
    rows = _replay(df, made, audits(converge(made)[0]), _turns, "key string, place long, edit string, role string, text string")
    ids = df.select(_key("conv_id").alias("key"), "conv_id").distinct()
    return rows.join(ids, "key").select("conv_id", "place", "edit", "role", "text")


def repair(df: DataFrame, ids: DataFrame | None = None, chunk_rows: int = 256) -> DataFrame:
    """Per conversation of ``ids`` (or of ``df``): gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    ``df`` has conv_id, turn, role and text. gaps = last turn - first + 1 - different turns (0 where all are null).
    """
    made = chunks(df, chunk_rows)
    audit = audits(converge(made)[0])
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "audit"))), lambda x: x["audit"]), "").alias("audit")
    found = made.drop("turn", "digest", "codes").join(audit, ["key", "k"]).groupBy("key").agg(
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal")], F.sum("total").alias("cost"), whole)
    turns = df.select(_key("conv_id").alias("key"), F.col("turn").cast("long").alias("turn")).groupBy("key").agg(
        (F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")).alias("gaps"))
    shas = _replay(df, made, audit, _digests, "key string, sha string")
    ids = (df if ids is None else ids).select(_key("conv_id").alias("key"), "conv_id").distinct()
    out = ids.join(found, "key", "left").join(turns, "key", "left").join(shas, "key", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return out.select("conv_id", *[zero(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
                      F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("sha", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))

"""WARC archives: write records through Spark, normalise monolithic gzip streams, read back by offset.

``write`` makes one record per row and stores each partition as one WARC file under a single gzip member, as careless
crawlers do. ``normalise`` inflates every such file once as a stream, rewrites each record as a gzip member of its own
and puts a sidecar index (one JSON line per record: offset, length, id, type) beside the new file. ``read_back`` seeks
each record by the index and inflates only its member.

Of the records with equal payloads of at least ``least`` bytes the one with the largest id is a response, the others
revisit it and carry no payload; rows that share this largest id are all responses. Null payloads are empty, a null id is
written as such and never a revisit's target, an empty table gives empty folders and an empty result, further columns are
not read. Files lie in the shared folder; the tasks that write them do so under a temporary name and rename at the end,
so a repeated task leaves the same file.
"""

from __future__ import annotations

import hashlib
import json
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import scratch, table

END = "\r\n\r\n"
CHUNK = 1 << 20


def with_types(df: DataFrame, least: int = 1000, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """page_id, url, payload, digest (SHA-1), size, type and refers_to of every row."""
    rows = df.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                     F.coalesce(F.col(payload_col).cast("string"), F.lit("")).alias("payload"))
    rows = rows.withColumns({"digest": F.sha1(F.encode("payload", "UTF-8")), "size": F.octet_length("payload").cast("long")})
    # one small row per payload that occurs twice or more, counted on the map side first; then a skew-safe equi-join
    shared = table(rows.where(F.col("size") >= least).groupBy("digest", "size")
                   .agg(F.max("page_id").alias("target"), F.count("*").alias("n")).where("n > 1").drop("n"), "warc-shared")
    revisit = F.col("target").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("target"))
    return (rows.join(shared, ["digest", "size"], "left")
            .select("page_id", "url", "payload", "digest", "size", F.when(revisit, "revisit").otherwise("response").alias("type"),
                    F.when(revisit, F.col("target")).alias("refers_to")))


def records(typed: DataFrame) -> DataFrame:
    """One column, value: the text of each WARC record without its closing line ends."""
    line = lambda name, value: F.concat(F.lit(name + ": "), value, F.lit("\r\n"))
    rid = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("null")), F.lit(">"))
    body = F.when(F.col("type") == "revisit", F.lit("")).otherwise(F.col("payload"))
    url = F.regexp_replace(F.coalesce("url", F.lit("")), "[\\x00-\\x20]", "%20")
    return typed.select(F.concat(
        F.lit("WARC/1.1\r\n"), line("WARC-Type", F.col("type")), line("WARC-Record-ID", rid(F.col("page_id"))),
        line("WARC-Target-URI", url),
        F.when(F.col("type") == "revisit", F.concat(
            line("WARC-Refers-To", rid(F.col("refers_to"))),
            F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\n"))).otherwise(F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))), line("X-Payload-Length", F.col("size").cast("string")),
        line("Content-Type", F.lit("text/html")), line("Content-Length", F.octet_length(body).cast("string")), F.lit("\r\n"), body,
    ).alias("value"))


def write(typed: DataFrame, path: str) -> str:
    """Each partition as one WARC file in a single gzip member, by Spark's own writer (any file system it knows)."""
    records(typed).write.option("lineSep", END).option("compression", "gzip").text(path)
    return path


class Stream:
    """Bytes of a gzip file of any number of members, inflated once from front to end; holds one chunk and one record."""

    def __init__(self, raw):
        self.raw, self.inflate, self.buffer = raw, zlib.decompressobj(31), bytearray()

    def more(self) -> bool:
        data = self.inflate.unused_data if self.inflate.eof else self.inflate.unconsumed_tail
        if self.inflate.eof:
            self.inflate = zlib.decompressobj(31)
        data = data or self.raw.read(CHUNK)
        if not data:
            return False
        self.buffer += self.inflate.decompress(data, CHUNK)
        return True

    def until(self, mark: bytes) -> bytes | None:
        """Up to and with the mark; None at the end of the stream."""
        seen = 0
        while (at := self.buffer.find(mark, seen)) < 0:
            seen = max(0, len(self.buffer) - len(mark) + 1)
            if not self.more():
                return None
        out = bytes(self.buffer[:at + len(mark)])
        del self.buffer[:at + len(mark)]
        return out

    def take(self, n: int) -> bytes:
        while len(self.buffer) < n and self.more():
            pass
        if len(self.buffer) < n:
            raise ValueError("the archive ends inside a record")
        out = bytes(self.buffer[:n])
        del self.buffer[:n]
        return out


def headers(block: bytes) -> dict[str, str]:
    return dict(x.split(": ", 1) for x in block.decode().strip().split("\r\n")[1:])


def _files(path: str):
    from pyarrow import fs

    where = path if "://" in path or path.startswith("/") else path.replace("file:", "", 1)
    return fs.FileSystem.from_uri(where)


def normalise(spark: SparkSession, source: str, target: str, level: int = 6) -> DataFrame:
    """Rewrite every archive below ``source`` into ``target``, one member per record, with a sidecar index; written result:
    archive, index, n_records. One task per archive; memory is bounded by the largest record, not by the archive."""
    archives = (spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(source)
                .select("path"))
    n = max(1, archives.count())

    def rewrite(path: str) -> tuple[str, str, int]:
        store, place = _files(path)
        out, folder = _files(target)
        out.create_dir(folder, recursive=True)
        name = place.rsplit("/", 1)[-1].split(".", 1)[0]
        paths = [f"{folder}/{name}.warc.gz", f"{folder}/{name}.warc.gz.idx"]
        parts = [f"{p}.{uuid.uuid4().hex}.part" for p in paths]
        offset = count = 0
        with store.open_input_stream(place, compression=None) as raw, out.open_output_stream(parts[0], compression=None) as archive, \
                out.open_output_stream(parts[1], compression=None) as index:
            stream = Stream(raw)
            while (head := stream.until(b"\r\n\r\n")) is not None:
                fields = headers(head)
                record = head + stream.take(int(fields["Content-Length"])) + stream.take(4)
                pack = zlib.compressobj(level, zlib.DEFLATED, 31)
                member = pack.compress(record) + pack.flush()
                archive.write(member)
                index.write(json.dumps({"offset": offset, "length": len(member), "id": fields["WARC-Record-ID"],
                                        "type": fields["WARC-Type"]}).encode() + b"\n")
                offset, count = offset + len(member), count + 1
        for part, final in zip(parts, paths):
            out.move(part, final)
        return paths[0], paths[1], count

    def run(batches):
        for batch in batches:
            done = [rewrite(p) for p in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([d[k] for d in done], t) for k, t in enumerate((pa.string(), pa.string(), pa.int64()))],
                                             names=["archive", "index", "n_records"])

    return table(archives.repartition(n, "path").mapInArrow(run, "archive string, index string, n_records long"), "warc-archives")


def read_back(spark: SparkSession, target: str) -> DataFrame:
    """One row per record of the archives below ``target``, found through their sidecar indexes: page_id, payload_bytes,
    payload_digest (recomputed from a response's payload, a revisit's from its header), record_type, refers_to, url."""
    entries = spark.read.schema("offset long, length long, id string, type string").option("pathGlobFilter", "*.idx").json(target)
    entries = entries.select("*", F.col("_metadata.file_path").alias("index"))
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string"

    def number(text):
        text = (text or "")[len("<urn:page:"):-1]
        return int(text) if text and text != "null" else None

    def run(batches):
        open_path, file = None, None
        for batch in batches:
            rows = []
            for offset, length, index in zip(*(batch.column(k).to_pylist() for k in (0, 1, 4))):
                if index != open_path:
                    if file is not None:
                        file.close()
                    store, place = _files(index)
                    open_path, file = index, store.open_input_file(place.removesuffix(".idx"))
                file.seek(offset)
                record = zlib.decompress(file.read(length), 31)
                head, body = record.split(b"\r\n\r\n", 1)
                fields, body = headers(head), body[:-4]
                if fields["WARC-Type"] == "response":
                    size, digest = len(body), hashlib.sha1(body).hexdigest()
                    if fields["WARC-Payload-Digest"] != "sha1:" + digest:
                        raise ValueError(f"digest of {fields['WARC-Record-ID']} does not match its payload")
                else:
                    size, digest = int(fields["X-Payload-Length"]), fields["WARC-Payload-Digest"].removeprefix("sha1:")
                rows.append((number(fields["WARC-Record-ID"]), size, digest, fields["WARC-Type"], number(fields.get("WARC-Refers-To")),
                             fields["WARC-Target-URI"]))
            yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], schema=kinds)
        if file is not None:
            file.close()

    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"]
    kinds = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                       ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string())])
    return entries.mapInArrow(run, schema)


def archive(df: DataFrame, least: int = 1000, level: int = 6, id_col: str = "page_id", url_col: str = "url",
            payload_col: str = "html") -> DataFrame:
    """Write, normalise and read back in the shared folder; the rows of ``read_back``."""
    spark = df.sparkSession
    raw, target = scratch(spark, "warc-raw"), scratch(spark, "warc")
    write(with_types(df, least, id_col, url_col, payload_col), raw)
    normalise(spark, raw, target, level)
    return read_back(spark, target)

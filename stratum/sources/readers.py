"""Batch sources (S1–S17): CSV with positional names or declared schema,
delimited text, line files, file-name values, JSON lines, generic formats,
images/binary files, variant-call text, annotation tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv_positional(spark: SparkSession, path: str, names: Sequence[str], infer: bool = True,
                        sep: str = ",") -> DataFrame:
    """Headerless CSV, types inferred (an extra pass) or all strings, columns named by position."""
    df = spark.read.csv(path, header=False, inferSchema=infer, sep=sep)
    return df.toDF(*names)


def read_csv_schema(spark: SparkSession, path: str, schema: T.StructType | str, sep: str = ",",
                    header: bool = False, mode: str = "PERMISSIVE") -> DataFrame:
    """CSV / delimited text with a declared schema (no inference pass); DROPMALFORMED drops junk lines."""
    return spark.read.schema(schema).csv(path, sep=sep, header=header, mode=mode)


def read_delimited_typed(spark: SparkSession, path: str, columns: Mapping[str, str], sep: str = "|",
                         strip: Mapping[str, str] | None = None) -> DataFrame:
    """Headerless delimited text as named, cleaned and typed columns, in one scan without an inference pass.

    ``columns`` gives names and SQL types by position (columns after the last one are not read); ``strip`` gives for a text
    column the pattern whose matches are removed before the rest is lower-cased. A field that is not of its type, and one
    that a short line lacks, is NULL; the other fields of that line are kept.
    """
    text = spark.read.schema(T.StructType([T.StructField(c, T.StringType()) for c in columns])).csv(path, sep=sep)
    for c, pattern in (strip or {}).items():
        text = text.withColumn(c, F.lower(F.regexp_replace(c, pattern, "")))
    return text.select(*[F.col(c) if t.lower() == "string" else F.trim(c).try_cast(t).alias(c) for c, t in columns.items()])


def read_csv_header(spark: SparkSession, path: str, infer: bool = True, sep: str = ",") -> DataFrame:
    """Directory of CSV files with a header line."""
    return spark.read.csv(path, header=True, inferSchema=infer, sep=sep)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Line-oriented text: one row per line in column ``value``."""
    return spark.read.text(path)


def with_path_value(df: DataFrame, pattern: str, out: str, cast: str = "int") -> DataFrame:
    """Value taken from each row's source file path (e.g. a year in the file name)."""
    return df.withColumn(out, F.regexp_extract(F.col("_metadata.file_path"), pattern, 1).cast(cast))


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def read_format(spark: SparkSession, fmt: str, path: str | None = None, schema: T.StructType | str | None = None,
                **options) -> DataFrame:
    """Any connector by name (keyed stores, JDBC, …); options pass through unchanged."""
    r = spark.read.format(fmt).options(**options)
    if schema is not None:
        r = r.schema(schema)
    return r.load(path) if path else r.load()


def read_binary_files(spark: SparkSession, path: str, glob: str | None = None, label: int | None = None) -> DataFrame:
    """Image / binary folder → (path, modificationTime, length, content[, label])."""
    r = spark.read.format("binaryFile")
    if glob:
        r = r.option("pathGlobFilter", glob)
    df = r.load(path)
    return df.withColumn("label", F.lit(label)) if label is not None else df


def read_images(spark: SparkSession, path: str, label: int | None = None) -> DataFrame:
    df = spark.read.format("image").option("dropInvalid", True).load(path)
    return df.withColumn("label", F.lit(label)) if label is not None else df


def read_annotation_table(spark: SparkSession, path: str, key: str) -> DataFrame:
    """Tab-separated annotation table with header and type imputation."""
    return spark.read.csv(path, sep="\t", header=True, inferSchema=True).withColumnRenamed(key, key)


def read_vcf(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Variant-call text (VCF, plain or gzip) → (variants, long genotypes).

    variants: (contig, pos, ref, alt, alts); genotypes: the same key (contig,
    pos, ref, alt), sample_index, sample_id (the header's name), alleles
    array<int>, gq, ad array<int>. ``alt`` is the list as written, so the key
    is the record's own text, not a hash of it. The text reader splits plain
    files at block boundaries; a line takes the header of its own file, or,
    where a file has none (part files), that of its folder. Only the list of
    the files with a header, shorter than the file listing, is broadcast to
    find which; the names themselves are joined to the calls one by one, by
    header and column, so that no call carries a line's names along. Without a
    header sample_id is NULL.
    """
    from stratum.session import cut_lineage

    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("_file"))
    lines = lines.withColumn("_folder", F.regexp_extract("_file", "^(.*)/[^/]*$", 1))
    named = lines.where(F.col("value").startswith("#CHROM")).select("_file", "_folder", F.slice(F.split("value", "\t"), 10, 1 << 30).alias("_names"))
    heads = named.groupBy("_file", "_folder").agg(F.max("_names").alias("_names"))
    heads = cut_lineage(heads.withColumn("_head", F.monotonically_increasing_id()))
    names = heads.select("_head", F.posexplode("_names").alias("sample_index", "sample_id"))
    own = heads.select("_file", F.col("_head").alias("_own"))
    shared = heads.groupBy("_folder").agg(F.max_by("_head", "_file").alias("_shared"))
    f = F.split("value", "\t", 10)  # the tenth part holds all calls
    body = lines.where(~F.col("value").startswith("#") & (F.col("value") != "")).select(
        f[0].alias("contig"), f[1].cast("long").alias("pos"), f[3].alias("ref"), f[4].alias("alt"), F.split(f[8], ":").alias("fmt"),
        F.split(F.get(f, F.lit(9)), "\t").alias("calls"), "_file", "_folder")
    key = ["contig", "pos", "ref", "alt"]
    variants = body.select(*key, F.split("alt", ",").alias("alts"))
    g = body.join(F.broadcast(own), "_file", "left").join(F.broadcast(shared), "_folder", "left")
    g = g.select(*key, "fmt", F.coalesce("_own", "_shared").alias("_head"), F.posexplode("calls").alias("sample_index", "call"))
    g = g.withColumn("_v", F.split("call", ":"))
    kv = F.map_from_arrays(F.slice("fmt", F.lit(1), F.size("_v")), F.col("_v"))  # fields at the end of a call may be left out
    gt = F.element_at(kv, "GT")
    alleles = F.transform(F.split(F.regexp_replace(gt, "\\|", "/"), "/"), lambda a: a.try_cast("int"))
    g = g.select(*key, "_head", "sample_index",
                 F.when(~gt.contains("."), alleles).alias("alleles"),
                 F.element_at(kv, "GQ").try_cast("int").alias("gq"),
                 F.transform(F.split(F.element_at(kv, "AD"), ","), lambda a: a.try_cast("int")).alias("ad"))
    g = g.join(names, ["_head", "sample_index"], "left")
    return variants, g.select(*key, "sample_index", "sample_id", "alleles", "gq", "ad")


def polynomial_table(spark: SparkSession, n: int, seed: int = 42, lo: float = -2.0, hi: float = 4.0,
                     noise: float = 1.0, coefs=(4.0, 6.0, 2.0, -1.0), partitions: int | None = None) -> DataFrame:
    """Random table: x ~ U[lo, hi), y = Σ c_k x^k + N(0, noise²); generated in parallel by ``spark.range``."""
    r = spark.range(0, n, numPartitions=partitions) if partitions else spark.range(0, n)
    x = F.lit(lo) + F.rand(seed) * F.lit(hi - lo)
    df = r.select("id", x.alias("x"))
    y = None
    for k, c in enumerate(coefs):
        term = F.lit(c) * F.pow(F.col("x"), k)
        y = term if y is None else y + term
    return df.withColumn("y", y + F.randn(seed + 1) * F.lit(noise))

"""Source / sink queries: each writes a driver table in some format below the
shared ``spark.checkpoint.dir``, reads it back with the source operator under
test and aggregates — checked against SQL over the original table."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.plans.registry import query
from stratum.plans.views import view, with_views
from stratum.session import checkpoint_dir, cut_lineage, load
from stratum.sources import readers as RD
from stratum.sources import sinks as SK


def _scratch(spark, name: str) -> str:
    return os.path.join(checkpoint_dir(spark), "stratum-io", f"{name}-{uuid.uuid4().hex[:12]}")


def R(c, d: int = 8):
    return F.round(c, d)


@query("csv_headerless_roundtrip", """
SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_quantity), 6) AS sum_qty
FROM lineitem GROUP BY 1, 2""")
def csv_headerless_roundtrip(spark, sf):
    li = load(spark, sf, "lineitem").select("l_orderkey", "l_quantity", "l_returnflag", "l_linestatus")
    path = _scratch(spark, "csv1")
    SK.write_csv(li, path, header=False)
    back = RD.read_csv_positional(spark, path, ["orderkey", "quantity", "returnflag", "linestatus"], infer=True)
    return back.groupBy(F.col("returnflag").alias("l_returnflag"), F.col("linestatus").alias("l_linestatus")).agg(
        F.count(F.lit(1)).alias("n"), R(F.sum("quantity"), 6).alias("sum_qty"))


ORDERS_DDL = ("o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP, o_orderpriority STRING")


@query("pipe_delimited_schema_read", """
SELECT o_orderstatus, count(*) AS n, round(avg(o_totalprice), 6) AS avg_price,
       CAST(min(o_orderdate) AS VARCHAR) AS first_date FROM orders GROUP BY 1""")
def pipe_delimited_schema_read(spark, sf):
    o = load(spark, sf, "orders")
    path = _scratch(spark, "pipe")
    SK.write_csv(o, path, sep="|", header=True)
    back = RD.read_csv_schema(spark, path, ORDERS_DDL, sep="|", header=True)
    return back.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), R(F.avg("o_totalprice"), 6).alias("avg_price"),
                                             F.min("o_orderdate").cast("string").alias("first_date"))


@query("delimited_notes_typed", """
SELECT lower(regexp_replace(o_orderpriority || '. Checked!', '[.!?-]', '', 'g')) AS note, CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n,
       count(CASE WHEN o_orderkey % 7 <> 0 THEN 1 END) AS n_timed,
       CAST(sum(CASE WHEN o_orderkey % 7 <> 0 THEN o_custkey % 90 END) AS BIGINT) AS minutes FROM orders GROUP BY 1, 2""")
def delimited_notes_typed(spark, sf):
    """Headerless pipe-delimited notes (date, note, minutes; some minutes not a number) named, cleaned and typed on reading."""
    path = _scratch(spark, "notes")
    notes = load(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("date"), F.concat("o_orderpriority", F.lit(". Checked!")).alias("note"),
                                             F.when(F.col("o_orderkey") % 7 == 0, F.lit("n/a")).otherwise((F.col("o_custkey") % 90).cast("string")).alias("minutes"))
    SK.write_csv(notes, path, sep="|", header=False)
    back = RD.read_delimited_typed(spark, path, {"date": "date", "note": "string", "minutes": "int"}, strip={"note": "[.!?-]"})
    return back.groupBy("note", F.year("date").alias("year")).agg(F.count(F.lit(1)).alias("n"), F.count("minutes").alias("n_timed"),
                                                                  F.sum("minutes").cast("long").alias("minutes"))


EVENT_JSON_SCHEMA = "event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"


@query("json_lines_roundtrip", """
SELECT event_type, count(*) AS n, round(avg(value), 8) AS avg_value,
       CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS sum_k FROM events GROUP BY 1""")
def json_lines_roundtrip(spark, sf):
    ev = load(spark, sf, "events")
    path = _scratch(spark, "json")
    ev.write.mode("overwrite").json(path)
    back = RD.read_json_lines(spark, path, EVENT_JSON_SCHEMA)
    k = F.get_json_object("props", "$.k").cast("long")
    return back.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), R(F.avg("value")).alias("avg_value"),
                                          F.sum(k).cast("long").alias("sum_k"))


@query("text_lines_path_value", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n, CAST(sum(o_custkey) AS BIGINT) AS sum_cust
FROM orders GROUP BY 1""")
def text_lines_path_value(spark, sf):
    o = load(spark, sf, "orders")
    lines = o.select(F.concat_ws(",", "o_orderkey", "o_custkey", "o_orderstatus").alias("value"),
                     F.year("o_orderdate").alias("year"))
    path = _scratch(spark, "text")
    lines.write.mode("overwrite").partitionBy("year").text(path)
    raw = RD.read_lines(spark, os.path.join(path, "*"))
    raw = raw.where(F.col("value").contains(","))
    parsed = RD.with_path_value(raw.select("value", "_metadata"), r"year=(\d+)", "year").select(
        "year", F.split("value", ",").getItem(1).cast("long").alias("custkey"))
    return parsed.groupBy("year").agg(F.count(F.lit(1)).alias("n"), F.sum("custkey").cast("long").alias("sum_cust"))


@query("external_parquet_table", """
SELECT c_mktsegment, count(*) AS n, round(avg(c_acctbal), 8) AS avg_balance FROM customer GROUP BY 1""")
def external_parquet_table(spark, sf):
    c = load(spark, sf, "customer")
    path = _scratch(spark, "ext")
    SK.write_parquet(c, path, compression="snappy")
    name = "stratum_customer_" + uuid.uuid4().hex[:8]
    t = SK.external_table(spark, name, path, fmt="parquet")
    t.createOrReplaceTempView(name + "_v")
    return spark.sql(f"SELECT c_mktsegment, count(*) AS n, round(avg(c_acctbal), 8) AS avg_balance "
                     f"FROM {name}_v GROUP BY c_mktsegment")


@query("external_csv_table", """
SELECT n_regionkey, count(*) AS n, min(n_name) AS first_name FROM nation GROUP BY 1""")
def external_csv_table(spark, sf):
    n = load(spark, sf, "nation")
    path = _scratch(spark, "extcsv")
    SK.write_csv(n, path, header=True)
    name = "stratum_nation_" + uuid.uuid4().hex[:8]
    t = SK.external_table(spark, name, path, fmt="csv", schema_ddl="n_nationkey INT, n_name STRING, n_regionkey INT",
                          options={"header": "true"})
    return t.groupBy("n_regionkey").agg(F.count(F.lit(1)).alias("n"), F.min("n_name").alias("first_name"))


#: Columns of a VCF line that are put together at a time.
VCF_PIECE = 256


def _vcf_lines(spark, sf):
    """Genotype view rendered as VCF text (header + one line per variant); the columns are the samples in order.

    A line is as wide as there are samples, so it is put together from pieces of ``VCF_PIECE`` columns: only the text of a
    line meets in one group, never its calls one by one.
    """
    from stratum.operators.profile import value_ranks

    g = view(spark, sf, "genotypes")
    call = F.concat(F.when(F.col("gt").isNull(), F.lit("./.")).when(F.col("gt") == 0, F.lit("0/0"))
                    .when(F.col("gt") == 1, F.lit("0/1")).otherwise(F.lit("1/1")),
                    F.lit(":"), F.col("gq").cast("string"), F.lit(":"),
                    F.concat_ws(",", F.col("ad_ref").cast("string"), F.col("ad_alt").cast("string")))
    samples = value_ranks(g.select(F.lit(0).alias("_g"), "sample_id").distinct(), ["_g"], "sample_id").select("sample_id", F.col("first").alias("sidx"))
    samples = cut_lineage(samples.select("sample_id", F.floor(F.col("sidx") / VCF_PIECE).cast("int").alias("_p"), (F.col("sidx") % VCF_PIECE).cast("int").alias("_i")))

    def row_of(pieces, *keys):
        """Per key the texts of its pieces, in order."""
        sorted_ = F.array_sort(F.collect_list(F.struct("_p", "_text")))
        return pieces.groupBy(*keys).agg(F.array_join(F.transform(sorted_, lambda x: x["_text"]), "\t").alias("_row"))

    # every sample has a column on every line, also those without a row for the variant
    calls = g.join(samples, "sample_id").groupBy("variant_id", "_p").agg(F.map_from_entries(F.collect_list(F.struct("_i", call))).alias("_c"))
    calls = cut_lineage(calls)
    every = g.select("variant_id", "contig", "pos").distinct().join(calls.select("variant_id"), "variant_id", "left_semi")
    columns = samples.groupBy("_p").agg(F.count(F.lit(1)).cast("int").alias("_w"))
    cells = every.crossJoin(F.broadcast(columns)).join(calls, ["variant_id", "_p"], "left")  # one row of two numbers a piece
    text = F.array_join(F.transform(F.sequence(F.lit(0), F.col("_w") - 1), lambda i: F.coalesce(F.try_element_at("_c", i), F.lit("."))), "\t")
    per = row_of(cells.select("variant_id", "contig", "pos", "_p", text.alias("_text")), "variant_id", "contig", "pos")
    body = per.select(F.concat_ws("\t", "contig", F.col("pos").cast("string"), F.lit("."), F.lit("A"), F.lit("G"),
                                  F.lit("."), F.lit("PASS"), F.lit("."), F.lit("GT:GQ:AD"), "_row").alias("value"))
    fixed = "\t".join(["#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT"])
    names = samples.groupBy("_p").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_i", "sample_id"))), lambda x: x["sample_id"].cast("string")),
                                                   "\t").alias("_text"))
    header = row_of(names).select(F.explode(F.array(F.lit("##fileformat=VCFv4.2"), F.concat_ws(
        "\t", F.lit(fixed), F.when(F.col("_row") != "", F.col("_row"))))).alias("value"))
    return header.unionByName(body)


@query("vcf_import", with_views(["genotypes"], """
SELECT contig, sample_id, count(gt) AS n_called, CAST(coalesce(sum(gt), 0) AS BIGINT) AS alt_alleles, CAST(sum(CASE WHEN gt IS NOT NULL THEN gq END) AS BIGINT) AS sum_gq
FROM genotypes GROUP BY contig, sample_id HAVING count(gt) > 0"""))
def vcf_import(spark, sf):
    """Genotypes written as VCF text and read back: calls per contig and sample name."""
    path = _scratch(spark, "vcf")
    _vcf_lines(spark, sf).write.mode("overwrite").text(path)
    _, gts = RD.read_vcf(spark, path)
    gt = F.aggregate(F.col("alleles"), F.lit(0), lambda a, x: a + F.when(x > 0, 1).otherwise(0))
    called = gts.where(F.col("alleles").isNotNull())
    return called.groupBy("contig", F.col("sample_id").cast("long").alias("sample_id")).agg(
        F.count(F.lit(1)).alias("n_called"), F.sum(gt).cast("long").alias("alt_alleles"), F.sum("gq").cast("long").alias("sum_gq"))


@query("binary_files_scan", """
SELECT CAST(sum(strlen(text) + 1) AS BIGINT) AS total_bytes, 1 AS label FROM documents""")
def binary_files_scan(spark, sf):
    """Document texts written as text files, scanned back as a binary-file folder with a constant label:
    the bytes read equal the UTF-8 text plus one newline per row (the file count depends on partitioning)."""
    d = load(spark, sf, "documents").select(F.col("text").alias("value"))
    path = _scratch(spark, "bin")
    SK.write_text(d, path)
    b = RD.read_binary_files(spark, path, glob="part-*", label=1)
    return b.agg(F.sum("length").cast("long").alias("total_bytes"), F.max("label").cast("int").alias("label"))


@query("csv_header_infer", """
SELECT p_type, count(*) AS n, round(avg(p_retailprice), 8) AS avg_price, CAST(sum(p_size) AS BIGINT) AS sum_size
FROM part GROUP BY 1""")
def csv_header_infer(spark, sf):
    """Directory of CSV files with a header line, types inferred."""
    path = _scratch(spark, "csvh")
    SK.write_csv(load(spark, sf, "part"), path, header=True)
    back = RD.read_csv_header(spark, path, infer=True)
    return back.groupBy("p_type").agg(F.count(F.lit(1)).alias("n"), R(F.avg("p_retailprice")).alias("avg_price"),
                                      F.sum("p_size").cast("long").alias("sum_size"))


@query("annotation_table_enrich", with_views(["genotypes", "samples"], """
SELECT super_population, count(gt) AS n_called, CAST(sum(gt) AS BIGINT) AS alt_alleles,
       count(*) FILTER (WHERE purple_hair) AS n_purple
FROM genotypes LEFT JOIN samples USING (sample_id) GROUP BY 1"""))
def annotation_table_enrich(spark, sf):
    """Tab-separated sample annotations (header, imputed types) nested under ``sa`` on the genotypes."""
    from stratum.operators.joins import enrich_nested

    path = _scratch(spark, "ann")
    SK.export_delimited(view(spark, sf, "samples"), path, sep="\t", header=True)
    ann = RD.read_annotation_table(spark, path, "sample_id")
    g = enrich_nested(view(spark, sf, "genotypes"), ann, "sample_id", "sa")
    return g.groupBy(F.col("sa.super_population").alias("super_population")).agg(
        F.count("gt").alias("n_called"), F.sum("gt").cast("long").alias("alt_alleles"),
        F.count_if(F.col("sa.purple_hair")).alias("n_purple"))


@query("interval_file_filter", with_views(["genotypes"], """
, iv AS (SELECT CASE WHEN p_partkey % 20 = 0 THEN 'X' ELSE CAST(p_partkey % 20 AS VARCHAR) END AS contig,
                p_partkey * 700 % 200000 AS start, p_partkey * 700 % 200000 + p_size * 30 AS "end" FROM part)
SELECT contig, count(DISTINCT variant_id) AS n_variants, count(*) AS n_genotypes FROM genotypes g
WHERE EXISTS (SELECT 1 FROM iv WHERE iv.contig = g.contig AND g.pos BETWEEN iv.start AND iv."end") GROUP BY contig"""))
def interval_file_filter(spark, sf):
    """Interval list written as a TSV file, read back, and used as a range filter (binned semi join)."""
    from stratum.operators.joins import interval_semi_join

    p = load(spark, sf, "part")
    contig = F.when(F.col("p_partkey") % 20 == 0, F.lit("X")).otherwise((F.col("p_partkey") % 20).cast("string"))
    start = F.col("p_partkey") * 700 % 200000
    iv = p.select(contig.alias("contig"), start.alias("start"), (start + F.col("p_size") * 30).alias("end"))
    path = _scratch(spark, "iv")
    SK.export_delimited(iv, path, sep="\t", header=True)
    back = RD.read_csv_schema(spark, path, "contig STRING, start BIGINT, end BIGINT", sep="\t", header=True)
    g = interval_semi_join(view(spark, sf, "genotypes"), back, bin_size=5_000)
    return g.groupBy("contig").agg(F.count_distinct("variant_id").alias("n_variants"), F.count(F.lit(1)).alias("n_genotypes"))


@query("bucketed_tables_join", """
SELECT o_orderstatus, count(*) AS n_lines, round(sum(l_extendedprice * (1 - l_discount)), 4) AS revenue
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""")
def bucketed_tables_join(spark, sf):
    """Managed tables bucketed by the join key (saveAsTable at a shared path, then CTAS): the join reads
    co-located buckets instead of shuffling both sides."""
    tag = uuid.uuid4().hex[:8]
    base = _scratch(spark, "bucketed")
    li, od = f"stratum_li_{tag}", f"stratum_od_{tag}"
    li_df = load(spark, sf, "lineitem").select("l_orderkey", "l_extendedprice", "l_discount")
    od_df = load(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    li_df.write.mode("overwrite").option("path", os.path.join(base, "li")).bucketBy(16, "l_orderkey") \
        .sortBy("l_orderkey").saveAsTable(li)
    od_df.write.mode("overwrite").option("path", os.path.join(base, "od")).bucketBy(16, "o_orderkey") \
        .sortBy("o_orderkey").saveAsTable(od)
    summary = f"stratum_rev_{tag}"
    spark.sql(f"DROP TABLE IF EXISTS {summary}")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {summary} USING parquet LOCATION '{os.path.join(base, 'rev')}' AS "
              f"SELECT o_orderstatus, l_extendedprice * (1 - l_discount) AS rev FROM {li} JOIN {od} "
              f"ON l_orderkey = o_orderkey")
    return spark.table(summary).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n_lines"),
                                                            F.round(F.sum("rev"), 4).alias("revenue"))


@query("export_sample_qc", with_views(["genotypes"], """
SELECT sample_id, count(gt) AS n_called, round(count(gt) / count(*), 8) AS call_rate FROM genotypes GROUP BY 1"""))
def export_sample_qc(spark, sf):
    """Chosen fields (``sample_id``, ``qc.*``) exported as tab-separated text and read back."""
    from stratum.operators.genotype import sample_qc

    q = sample_qc(view(spark, sf, "genotypes"))
    nested = q.select("sample_id", F.struct("n_called", "call_rate").alias("qc"))
    path = _scratch(spark, "export")
    SK.export_delimited(nested.select("sample_id", "qc.*"), path)
    back = RD.read_format(spark, "csv", path, schema="sample_id BIGINT, n_called BIGINT, call_rate DOUBLE",
                          sep="\t", header="true")
    return back.select("sample_id", "n_called", R(F.col("call_rate")).alias("call_rate"))


@query("fill_empty_cells", with_views(["flights"], """
SELECT origin, round(sum(coalesce(dep_delay, 0)), 6) AS sum_dep, round(sum(coalesce(arr_delay, 0)), 6) AS sum_arr,
       count(*) AS n FROM flights GROUP BY origin"""))
def fill_empty_cells(spark, sf):
    """CSV with empty cells (missing delays) read with a schema; empty numeric cells filled with 0."""
    from stratum.operators.clean import fill_missing

    f = view(spark, sf, "flights").select("origin", "dep_delay", "arr_delay")
    path = _scratch(spark, "empty")
    SK.write_csv(f, path)
    back = RD.read_csv_schema(spark, path, "origin STRING, dep_delay DOUBLE, arr_delay DOUBLE")
    back = fill_missing(back, 0.0, ["dep_delay", "arr_delay"])
    return back.groupBy("origin").agg(R(F.sum("dep_delay"), 6).alias("sum_dep"), R(F.sum("arr_delay"), 6).alias("sum_arr"),
                                      F.count(F.lit(1)).alias("n"))


@query("junk_lines_cleanup", with_views(["raw_seasons"], """
SELECT year, count(*) AS n_rows, count(*) FILTER (WHERE team = 'TOT') AS n_total_rows, round(sum(fga), 6) AS sum_fga
FROM raw_seasons GROUP BY year"""))
def junk_lines_cleanup(spark, sf):
    """Season text files with repeated header lines, blank lines and ``*`` markers after names:
    junk lines dropped, markers stripped, year taken from the file path."""
    from stratum.operators.clean import drop_junk_lines

    raw = view(spark, sf, "raw_seasons")
    name = F.when(F.col("team") == "TOT", F.concat("name", F.lit("*"))).otherwise(F.col("name"))
    lines = raw.select("year", F.concat_ws(",", name, "team", F.col("fga").cast("string")).alias("value"))
    junk = raw.select("year").distinct().select("year", F.explode(F.array(F.lit("Player,Tm,FGA"), F.lit(""),
                                                                          F.lit("Player,Tm,FGA"))).alias("value"))
    path = _scratch(spark, "junk")
    lines.unionByName(junk).write.mode("overwrite").partitionBy("year").text(path)
    txt = RD.with_path_value(RD.read_lines(spark, os.path.join(path, "*")).select("value", "_metadata"),
                             r"year=(\d+)", "year")
    clean = drop_junk_lines(txt, "value", header_marker="FGA", require=",", strip="*")
    parts = F.split("value", ",")
    rows = clean.select("year", parts.getItem(1).alias("team"), parts.getItem(2).cast("double").alias("fga"))
    return rows.groupBy("year").agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("team") == "TOT").alias("n_total_rows"),
                                    R(F.sum("fga"), 6).alias("sum_fga"))


@query("stream_json_values", with_views(["readings", "tag_mappings"], """
SELECT sensor_name, count(*) AS n, round(sum(value), 6) AS sum_value
FROM readings JOIN tag_mappings USING (tag_id) GROUP BY sensor_name"""))
def stream_json_values(spark, sf):
    """Message-queue shape: JSON strings in a text stream → typed columns (schema given) → enrichment."""
    from stratum.streaming import sensors as ST

    r = view(spark, sf, "readings")
    path = _scratch(spark, "jsonstream")
    r.select(F.to_json(F.struct("record_time", "tag_id", "value")).alias("value")).write.mode("overwrite").text(path)
    stream = spark.readStream.format("text").option("pathGlobFilter", "part-*").load(path)
    parsed = ST.parse_json_values(stream, ST.READING_SCHEMA)
    enriched = ST.enrich_stream(parsed, view(spark, sf, "tag_mappings")).select("sensor_name", "value")
    out = ST.run_available_now(enriched, "jsonvalues")
    back = ST.read_output(spark, out, T.StructType([T.StructField("sensor_name", T.StringType()),
                                                    T.StructField("value", T.DoubleType())]))
    return back.groupBy("sensor_name").agg(F.count(F.lit(1)).alias("n"), R(F.sum("value"), 6).alias("sum_value"))

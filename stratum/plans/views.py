"""Derived views that give the driver tables the shapes the operators expect.

Each view is one SQL text over the driver tables. Spark runs it with
DataFrame parameters (``spark.sql(text, lineitem=df, ...)``), so no
session-global names are touched; the oracle runs the same text as a CTE.
Every view is an ordinary relational plan over whole tables, so Catalyst
prunes columns and pushes filters of the consuming query into the scans.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from stratum.session import load

VIEWS: dict[str, str] = {
    # shape of an airline on-time table
    "flights": """
SELECT l_orderkey, l_linenumber, CAST(year(l_shipdate) AS INT) AS year, CAST(month(l_shipdate) AS INT) AS month,
       CAST(day(l_shipdate) AS INT) AS day,
       p_brand AS carrier, CAST(l_partkey AS STRING) AS flight, sn.n_name AS origin, cn.n_name AS dest,
       CAST((l_orderkey % 24) * 100 + l_partkey % 60 AS INT) AS sched_arr_time,
       CASE WHEN l_linenumber = 7 THEN NULL ELSE l_quantity * 4 - 100 END AS dep_delay,
       CASE WHEN l_linenumber >= 6 THEN NULL
            ELSE (l_quantity * 4 - 100) * 1.02 - 5.9 + l_tax * 200 - l_discount * 300 END AS arr_delay
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey JOIN {customer} ON o_custkey = c_custkey
JOIN {nation} cn ON c_nationkey = cn.n_nationkey JOIN {supplier} ON l_suppkey = s_suppkey
JOIN {nation} sn ON s_nationkey = sn.n_nationkey JOIN {part} ON l_partkey = p_partkey""",
    # shape of an airport coordinate table
    "airports": """
SELECT n_name AS iata, CAST((n_nationkey * 37) % 360 - 180 AS DOUBLE) AS longitude,
       CAST((n_nationkey * 23) % 140 - 70 AS DOUBLE) AS latitude FROM {nation}""",
    # maintenance cost records with actual and predicted maintenance type
    "maintenance": """
SELECT o_orderkey AS maint_id, DATE '2024-01-01' + CAST(o_orderkey % 30 AS INT) AS date, CAST(floor(o_totalprice) AS INT) AS cost,
       CASE o_orderstatus WHEN 'F' THEN 'Corrective' WHEN 'P' THEN 'Preventive' ELSE 'Healthy' END AS maintenance_type,
       CASE WHEN o_orderpriority = '1-URGENT' THEN 'Corrective' WHEN o_orderpriority = '2-HIGH' THEN 'Preventive'
            ELSE 'Healthy' END AS predicted_type
FROM {orders}""",
    "tag_mappings": """
SELECT DISTINCT CAST(user_id % 10 AS INT) AS tag_id, concat('Sensor_', CAST(user_id % 10 AS STRING)) AS sensor_name FROM {events}""",
    # sensor readings (also the stream source)
    "readings": """
SELECT event_id, ts AS record_time, CAST(user_id % 10 AS INT) AS tag_id, value FROM {events}""",
    # player-season lines: several team rows per (name, year), the TOT row preferred
    "raw_seasons": """
SELECT c_name AS name, CAST(year(o_orderdate) AS INT) AS year, CAST(18 + year(o_orderdate) - 1995 + c_custkey % 15 AS INT) AS age,
       CASE WHEN o_orderpriority = '1-URGENT' THEN 'TOT' ELSE o_orderpriority END AS team,
       sum(l_quantity) AS fga, avg(l_discount) AS fgp, CAST(count(*) AS DOUBLE) AS fta, avg(l_tax) AS ftp,
       max(l_quantity) AS tp, min(l_quantity) AS trb, max(l_extendedprice) AS pts, CAST(sum(l_linenumber) AS DOUBLE) AS tov
FROM {orders} JOIN {customer} ON o_custkey = c_custkey JOIN {lineitem} ON l_orderkey = o_orderkey GROUP BY 1, 2, 3, 4""",
    # the same with three more counting statistics: all nine scores
    "raw_seasons9": """
SELECT c_name AS name, CAST(year(o_orderdate) AS INT) AS year, CAST(18 + year(o_orderdate) - 1995 + c_custkey % 15 AS INT) AS age,
       CASE WHEN o_orderpriority = '1-URGENT' THEN 'TOT' ELSE o_orderpriority END AS team,
       sum(l_quantity) AS fga, avg(l_discount) AS fgp, CAST(count(*) AS DOUBLE) AS fta, avg(l_tax) AS ftp,
       max(l_quantity) AS tp, min(l_quantity) AS trb, max(l_extendedprice) AS pts, CAST(sum(l_linenumber) AS DOUBLE) AS tov,
       avg(l_quantity) AS ast, CAST(sum(l_suppkey % 7) AS DOUBLE) AS stl, avg(l_extendedprice) AS blk
FROM {orders} JOIN {customer} ON o_custkey = c_custkey JOIN {lineitem} ON l_orderkey = o_orderkey GROUP BY 1, 2, 3, 4""",
    "sessions": """
SELECT vec_id, label, embedding FROM {embeddings}""",
    # one-hot block like a forest-cover table (rows of other part types have no 1.0)
    "cover": """
SELECT p_partkey, p_retailprice AS elevation, p_size AS slope, p_size % 7 AS cover_type,
       CASE WHEN p_type = 'STANDARD' THEN 1.0E0 ELSE 0.0E0 END AS w0, CASE WHEN p_type = 'PROMO' THEN 1.0E0 ELSE 0.0E0 END AS w1,
       CASE WHEN p_type = 'SMALL' THEN 1.0E0 ELSE 0.0E0 END AS w2, CASE WHEN p_type = 'LARGE' THEN 1.0E0 ELSE 0.0E0 END AS w3
FROM {part}""",
    "churn": """
SELECT c_custkey, c_mktsegment AS state, c_acctbal AS account_balance, CAST(count(o_orderkey) AS DOUBLE) AS n_calls,
       coalesce(sum(o_totalprice), 0) AS total_charge, CASE WHEN c_acctbal < 2000 THEN 1 ELSE 0 END AS churned
FROM {customer} LEFT JOIN {orders} ON c_custkey = o_custkey GROUP BY 1, 2, 3""",
    "samples": """
SELECT s_suppkey AS sample_id, r_name AS super_population, s_suppkey % 2 = 0 AS is_female, s_acctbal > 5000 AS purple_hair,
       s_acctbal / 1000 AS caffeine
FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey""",
    # long genotype table: 0/1/2 alternate alleles, NULL = no call
    "genotypes": """
SELECT variant_id, CASE WHEN variant_id % 20 = 0 THEN 'X' ELSE CAST(variant_id % 20 AS STRING) END AS contig,
       variant_id * 1000 AS pos, sample_id,
       CASE WHEN q >= 49 THEN NULL ELSE g END AS gt, gq, 10 - g * 5 + (n % 3) AS ad_ref, g * 5 + (n % 2) AS ad_alt
FROM (SELECT l_partkey % 200 AS variant_id, l_suppkey AS sample_id, CAST(sum(l_linenumber) % 3 AS INT) AS g,
             CAST(count(*) AS INT) AS n, max(l_quantity) AS q, CAST(floor(avg(l_quantity) * 2) AS INT) AS gq
      FROM {lineitem} GROUP BY 1, 2) t""",
}

_REF = re.compile(r"\{(\w+)\}")


def tables_of(name: str) -> list[str]:
    return sorted(set(_REF.findall(VIEWS[name])))


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Build a derived view as a lazy DataFrame over the driver tables in ``sf_dir``."""
    args = {t: load(spark, sf_dir, t) for t in tables_of(name)}
    return spark.sql(VIEWS[name], **args)


def sql_text(name: str) -> str:
    """The view body with plain table names (for DuckDB / any SQL engine)."""
    return _REF.sub(lambda m: m.group(1), VIEWS[name]).strip()


def with_views(names: list[str], body: str) -> str:
    """Prefix ``body`` with CTEs for the named views (oracle SQL)."""
    ctes = ",\n".join(f"{n} AS ({sql_text(n)})" for n in names)
    b = body.strip()
    m = re.match(r"WITH\s", b, re.IGNORECASE)
    if m:
        return f"WITH {ctes},\n{b[m.end():]}"
    return f"WITH {ctes}\n{b}"

"""Run one registered query as a batch job (spark-submit or python -m stratum.cli).

    python -m stratum.cli QUERY SF_DIR [--out PATH] [--show N] [--input-bytes N]

With ``--out`` the full result is written as Parquet (overwrite); otherwise
``--show`` rows are printed. ``--input-bytes`` applies the cluster sizing of
:func:`stratum.session.cluster_settings`. On a cluster the job uses the
session spark-submit provides; locally it creates one.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from stratum.plans.registry import QUERIES, load_all
from stratum.session import apply_settings, cluster_settings, get_spark, prepare


def main(argv: list[str] | None = None) -> None:
    load_all()
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("query", choices=sorted(QUERIES))
    ap.add_argument("sf_dir")
    ap.add_argument("--out")
    ap.add_argument("--show", type=int, default=20)
    ap.add_argument("--input-bytes", type=int)
    a = ap.parse_args(argv)
    spark = SparkSession.getActiveSession() or get_spark("stratum-cli")
    prepare(spark)
    if a.input_bytes:
        apply_settings(spark, cluster_settings(a.input_bytes))
    df = QUERIES[a.query](spark, a.sf_dir)
    if a.out:
        df.write.mode("overwrite").parquet(a.out)
    else:
        df.show(a.show, truncate=False)


if __name__ == "__main__":
    main()

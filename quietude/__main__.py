"""Command line: ``python -m quietude <job> ...`` runs one end-to-end job.

    word-count IN OUT | keyword-search IN OUT [--keyword K] | sort-by-name IN OUT
    preprocess RAW_CSV BASE_COL OUT_ROOT
    signal READINGS_TSV OUT_ROOT
    trends READINGS_PARQUET OUT_ROOT
    store READINGS_PARQUET STORE_ROOT --run-ts TS
    complaints READINGS_PARQUET OUT_ROOT --run-ts TS [--n 500]
"""

from __future__ import annotations

import argparse

from quietude.plans import jobs as P
from quietude.session import get_session


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="quietude")
    ap.add_argument("job", choices=["word-count", "keyword-search", "sort-by-name", "preprocess",
                                    "signal", "trends", "store", "complaints"])
    ap.add_argument("args", nargs="+")
    ap.add_argument("--keyword", default="hadoop")
    ap.add_argument("--run-ts", default=None)
    ap.add_argument("--n", type=int, default=500)
    a = ap.parse_args(argv)
    spark = get_session(app=f"quietude-{a.job}")
    x = a.args
    if a.job == "word-count":
        P.word_count_job(spark, x[0], x[1])
    elif a.job == "keyword-search":
        P.keyword_search_job(spark, x[0], x[1], a.keyword)
    elif a.job == "sort-by-name":
        P.sort_by_name_job(spark, x[0], x[1])
    elif a.job == "preprocess":
        P.preprocessing_job(spark, x[0], x[1], x[2])
    elif a.job == "signal":
        P.signal_processing_job(spark, x[0], x[1])
    elif a.job == "trends":
        P.trend_queries_job(spark, spark.read.parquet(x[0]), x[1])
    elif a.job == "store":
        for name, df in P.storage_job(spark, spark.read.parquet(x[0]), x[1], a.run_ts).items():
            print(name)
            df.show(truncate=False)
    elif a.job == "complaints":
        P.complaints_job(spark, spark.read.parquet(x[0]), x[1], a.run_ts, a.n)


if __name__ == "__main__":
    main()

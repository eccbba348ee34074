"""Command line: run a whole lab on text inputs, or one registered query.

    python -m revlens ratings --ratings r1.txt r2.txt --items items.txt \\
        --users raters.txt --out OUT [--min-count 5] [--age-bounds 0 18 35 50]
    python -m revlens reviews --reviews reviews.csv --stop-words stop.txt \\
        --out OUT [--threshold 500] [--k 5] [--quoting]
    python -m revlens query NAME --sf-dir DIR --out OUT
    python -m revlens explain NAME --sf-dir DIR [--mode formatted]

On a cluster, submit with spark-submit; the session settings (master,
shuffle partitions, spark.checkpoint.dir) come from the submit command.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from revlens.session import ensure_checkpoint_dir


def _session(local: bool) -> SparkSession:
    if local:
        from revlens.session import local_session
        return local_session()
    spark = SparkSession.builder.appName("revlens").getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="revlens")
    p.add_argument("--local", action="store_true", help="run in local mode")
    sub = p.add_subparsers(dest="cmd", required=True)

    r = sub.add_parser("ratings", help="item, genre, gender and age-group averages")
    r.add_argument("--ratings", nargs="+", required=True)
    r.add_argument("--items", required=True)
    r.add_argument("--users", required=True)
    r.add_argument("--out", required=True)
    r.add_argument("--min-count", type=int, default=5)
    r.add_argument("--age-bounds", type=float, nargs="+", default=[0, 18, 35, 50])
    r.add_argument("--keep-existing", action="store_true",
                   help="fail instead of replacing existing output folders")
    r.add_argument("--single-file", action="store_true")
    r.add_argument("--threads", type=int, default=4,
                   help="driver threads submitting independent outputs")

    v = sub.add_parser("reviews", help="word and comment statistics of reviews")
    v.add_argument("--reviews", required=True)
    v.add_argument("--stop-words", required=True)
    v.add_argument("--out", required=True)
    v.add_argument("--threshold", type=int, default=500)
    v.add_argument("--k", type=int, default=5)
    v.add_argument("--quoting", action="store_true", help="honour double quotes")
    v.add_argument("--multiline", action="store_true", help="with --quoting, line breaks within quotes")
    v.add_argument("--keep-existing", action="store_true",
                   help="fail instead of replacing existing output folders")
    v.add_argument("--single-file", action="store_true")
    v.add_argument("--threads", type=int, default=4,
                   help="driver threads submitting independent outputs")

    q = sub.add_parser("query", help="one registered query over the parquet tables")
    q.add_argument("name")
    q.add_argument("--sf-dir", required=True)
    q.add_argument("--out", required=True)

    x = sub.add_parser("explain", help="print the plan of a registered query")
    x.add_argument("name")
    x.add_argument("--sf-dir", required=True)
    x.add_argument("--mode", default="formatted",
                   choices=["simple", "extended", "codegen", "cost", "formatted"])

    a = p.parse_args(argv)
    spark = _session(a.local)
    if a.cmd == "ratings":
        from revlens.plans.report import run_ratings_files
        bounds = [int(b) if float(b).is_integer() else b for b in a.age_bounds]
        paths = run_ratings_files(spark, a.ratings, a.items, a.users, a.out,
                                  min_count=a.min_count, age_bounds=bounds,
                                  mode="errorifexists" if a.keep_existing else "overwrite",
                                  single_file=a.single_file,
                                  threads=a.threads)
    elif a.cmd == "reviews":
        from revlens.plans.report import run_reviews_files
        paths = run_reviews_files(spark, a.reviews, a.stop_words, a.out, quoting=a.quoting, multiline=a.multiline,
                                  threshold=a.threshold, k=a.k, single_file=a.single_file,
                                  mode="errorifexists" if a.keep_existing else "overwrite",
                                  threads=a.threads)
    elif a.cmd == "explain":
        from revlens.plans.catalog import queries
        queries()[a.name](spark, a.sf_dir).explain(a.mode)
        return
    else:
        from revlens.plans.catalog import queries
        from revlens.sources.sinks import write_tsv
        write_tsv(queries()[a.name](spark, a.sf_dir), a.out, mode="overwrite")
        paths = {a.name: a.out}
    print(json.dumps(paths))


if __name__ == "__main__":
    main()

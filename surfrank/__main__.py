"""Command line: ``spark-submit -m surfrank <input> <output> <iterations> <alpha> [options]``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from surfrank.plans.job import run_job
from surfrank.plans.presets import PRESETS


USAGE = """positional arguments, as in the two familiar forms:
  <input> <output> <iterations> <reducers> <alpha>   (reducers = partitions)
  <input> <output> <iterations> <alpha>"""


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(
        prog="surfrank",
        description="Rank the pages of a line-oriented wiki dump.",
        epilog=USAGE,
        formatter_class=argparse.RawDescriptionHelpFormatter,
    )
    ap.add_argument("args", nargs="+", metavar="ARG")
    ap.add_argument("--preset", default="mapreduce", choices=sorted(PRESETS))
    ap.add_argument("--partitions", type=int, default=None)
    ap.add_argument("--checkpoint-every", type=int, default=5, help="0 = only after the last step")
    ap.add_argument("--keep-state", action="store_true", help="mapreduce layout: also write edges/, parse/ and rank-<i>/")
    ap.add_argument("--state-format", default="parquet", choices=["parquet", "text"], help="of the kept states: tables, or a line for each page")
    ap.add_argument("--resume-from", default=None, metavar="FOLDER", help="go on from a kept parse/ or rank-<i>/; <input> is not read")
    ap.add_argument("--dictionary", action="store_true", help="run the steps on numbers in place of titles")
    ns = ap.parse_args(argv)
    if len(ns.args) == 5:
        src, dst, iterations, reducers, alpha = ns.args
        partitions = int(reducers)
    elif len(ns.args) == 4:
        src, dst, iterations, alpha = ns.args
        partitions = ns.partitions
    else:
        ap.error("expected 4 or 5 positional arguments")
    float(alpha)  # validate early; the text itself is kept (exact for float32 arithmetic)
    spark = SparkSession.builder.appName("surfrank").getOrCreate()
    run_job(
        spark, src, dst, int(iterations), alpha, ns.preset, partitions,
        ns.checkpoint_every or None, ns.keep_state, resume_from=ns.resume_from, state_format=ns.state_format, dictionary=ns.dictionary,
    )


if __name__ == "__main__":
    main()

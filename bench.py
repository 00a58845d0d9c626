"""Benchmark: prints one JSON line with the headline timings.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 4),
BENCH_RUNS (default 5, median reported), BENCH_EVENT_LOG (set: write Spark's
event log to the scratch folder; summarise with scripts/stage_times.py).  The page lines of each fixture are
written once as text (not timed); every timed run then starts from the text
files, as a real job would.

Metrics (seconds):
  build_wp / build_wh   parse + graph build (edges and nodes cached and checkpointed once)
  build_wp_cache_only   the same without the reliable copy of the graph tables
  iter_wp               per step, 10 steps, alpha 0.15 (checkpoint every 5)
  rank10_wp             build + 10 steps (ranks materialised)
  job_wp                whole job: text in, 10 steps, global sort, TSV sink
  job_wh_py             whole job on the web-page graph, Python-tuple preset and sink
  ckpt1_wp / ckptnone_wp  10 steps with checkpoint every step / only at the end
  rank10_wp_hot         rank10_wp with the skew layout forced on (a mix of hot and regular sources)
The headline value is job_wp.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from pyspark.sql import SparkSession  # noqa: E402

from surfrank import fixtures as X  # noqa: E402
from surfrank.plans.job import rank_pages, run_job  # noqa: E402
from surfrank.sources.text import read_lines, write_lines  # noqa: E402


def session(cpus: int, scratch: str) -> SparkSession:
    builder = SparkSession.builder
    if os.environ.get("BENCH_EVENT_LOG"):
        # stage/task timings for scripts/stage_times.py; written to the scratch folder
        events = os.path.join(scratch, "events")
        os.makedirs(events, exist_ok=True)
        builder = builder.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", events)
        print(f"event log: {events}", file=sys.stderr)
    spark = (
        builder.master(f"local[{cpus}]")
        .appName("surfrank-bench")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.default.parallelism", str(cpus))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.local.dir", os.path.join(scratch, "local"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(os.path.join(scratch, "checkpoints"))
    return spark


def _sf(sf_dir: str):
    label = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    try:
        return float(label)
    except ValueError:
        return label


def timed(fn, runs: int) -> float:
    times = []
    for _ in range(runs):
        t0 = time.perf_counter()
        fn()
        times.append(time.perf_counter() - t0)
    return statistics.median(times)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "4"))
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    scratch = tempfile.mkdtemp(prefix="surfrank-bench-")
    spark = session(cpus, scratch)

    inputs = {}
    for fx in ("wp", "wh"):
        path = os.path.join(scratch, f"{fx}-lines")
        write_lines(X.lines(spark, sf_dir, fx), path)
        inputs[fx] = path

    def build(fx, reliable=True):
        def go():
            res = rank_pages(read_lines(spark, inputs[fx]), 0, 0.15, reliable_graph=reliable)
            res.layout.release()

        return go

    def rank(iterations, checkpoint_every, **kw):
        def go():
            res = rank_pages(read_lines(spark, inputs["wp"]), iterations, 0.15, checkpoint_every=checkpoint_every, **kw)
            res.layout.release()

        return go

    counter = [0]

    def job(fx="wp", preset="mapreduce"):
        def go():
            counter[0] += 1
            out = os.path.join(scratch, f"job-{counter[0]}")
            res = run_job(spark, inputs[fx], out, 10, 0.15, preset)  # count + sort (MR) or pairs
            res.layout.release()

        return go

    # warm-up: JIT, class loading, file listing caches
    build("wp")()
    rank(2, 5)()

    q = {}
    q["build_wp"] = timed(build("wp"), runs)
    q["build_wh"] = timed(build("wh"), runs)
    q["build_wp_cache_only"] = timed(build("wp", False), runs)
    q["rank10_wp"] = timed(rank(10, 5), runs)
    q["iter_wp"] = max(0.0, (q["rank10_wp"] - q["build_wp"]) / 10)
    q["job_wp"] = timed(job(), runs)
    q["job_wh_py"] = timed(job("wh", "rdd_py"), runs)
    q["ckpt1_wp"] = timed(rank(10, 1), runs)
    q["ckptnone_wp"] = timed(rank(10, None), runs)
    q["rank10_wp_hot"] = timed(rank(10, 5, hot_floor=1, hot_factor=1024), runs)
    q = {k: round(v, 3) for k, v in q.items()}
    print(
        json.dumps(
            {
                "metric": "job_wp_seconds",
                "value": q["job_wp"],
                "unit": "sec",
                "queries": q,
                "sf": _sf(sf_dir),
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

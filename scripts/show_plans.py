"""Print the physical plan of one ranking step (and of the hot-source variant).

Usage: python scripts/show_plans.py [sf_dir]
"""

from __future__ import annotations

import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from surfrank import fixtures as X  # noqa: E402
from surfrank.operators.rank import RankConstants, rank_step  # noqa: E402
from surfrank.plans import job  # noqa: E402
from surfrank.session import job_conf, local_session  # noqa: E402


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    lines = X.lines(spark, sf, "wp")
    for label, kw in (("regular layout", {}), ("hot sources forced", {"hot_floor": 1, "hot_factor": 64})):
        trace: list = []
        res = job.rank_pages(lines, 6, 0.15, checkpoint_every=5, trace=trace, **kw)
        with job_conf(spark, job.job_settings(res.layout.num_partitions)):
            step = rank_step(res.layout, trace[-1][1], RankConstants.of(0.15, res.n_lines))
            print(f"===== one step, {label} (hot sources: {res.layout.n_hot}) =====")
            step.explain("formatted")
        res.layout.release()


if __name__ == "__main__":
    main()

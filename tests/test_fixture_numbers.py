"""Sizes and rank sums of the derived graphs, as recorded independently in FIXTURES.md §3."""

import pytest
from pyspark.sql import functions as F

from surfrank import fixtures as X
from surfrank import rank_pages

CASES = [
    # (sf, fixture, preset, N lines, |V|, rank sum after 4 steps or None)
    ("0.001", "wp", "mapreduce", 200, 200, None),
    ("0.01", "wp", "mapreduce", 2000, 2000, None),
    ("0.001", "wh", "mapreduce", 50, 292, 0.97035),
    ("0.01", "wh", "mapreduce", 250, 490, 0.38784),
    ("0.001", "wd", "mapreduce", 200, 176, 0.358544),
    ("0.001", "wd", "rdd_py", 200, 236, 0.365376),
    ("0.01", "wd", "mapreduce", 1000, 472, 0.274320),
    ("0.01", "wd", "rdd_py", 1000, 744, 0.368346),
]


@pytest.mark.parametrize("sf,fx,preset,n,v,total", CASES)
def test_fixture_sizes_and_rank_sums(spark, sf, fx, preset, n, v, total):
    res = rank_pages(X.lines(spark, f"/root/testdata/sf{sf}", fx), 4, 0.15, preset)
    assert res.n_lines == n
    assert res.layout.n_vertices == v
    if total is not None:
        got = res.ranks().agg(F.sum("rank")).first()[0]
        assert got == pytest.approx(total, abs=5e-6)


def test_wp_distinct_edges(spark):
    res = rank_pages(X.lines(spark, "/root/testdata/sf0.01", "wp"), 0, 0.15)
    assert res.layout.edges().count() == 29093

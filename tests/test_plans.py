"""Physical plan shape of a step: one exchange, partial sums, no Python, no re-shuffle of cached tables."""


import pytest

from surfrank import fixtures as X
from surfrank.operators.rank import RankConstants, join_sources, rank_step, shares
from surfrank.plans import job, layout
from surfrank.session import job_conf

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def without_cached_builds(plan: str) -> str:
    """Drop the build plans nested under InMemoryRelation nodes (computed once, then cached)."""
    out, skip_deeper = [], None
    for line in plan.splitlines():
        depth = len(line) - len(line.lstrip(" :|+-"))
        if skip_deeper is not None and depth > skip_deeper:
            continue
        skip_deeper = None
        out.append(line)
        if "InMemoryRelation" in line:
            skip_deeper = depth
    return "\n".join(out)


def step_plan(spark, **kw):
    trace = []
    res = job.rank_pages(X.lines(spark, SF, "wp"), 5, 0.15, checkpoint_every=5, trace=trace, **kw)
    with job_conf(spark, job.job_settings(res.layout.num_partitions)):
        nxt = rank_step(res.layout, trace[-1][1], RankConstants.of(0.15, res.n_lines))
        nxt.collect()
        return plan_of(nxt), res


def test_one_exchange_per_step(spark):
    plan, _ = step_plan(spark)
    top = without_cached_builds(plan)
    assert top.count("Exchange hashpartitioning") == 1
    assert "partial_sum" in plan
    assert "BroadcastExchange" not in top
    assert "ArrowEvalPython" not in plan and "BatchEvalPython" not in plan


def test_hot_step_has_bounded_broadcast_and_no_extra_exchange(spark):
    plan, res = step_plan(spark, hot_floor=1, hot_factor=64)
    assert res.layout.n_hot > 0
    top = without_cached_builds(plan)
    assert top.count("Exchange hashpartitioning") == 1
    assert "BroadcastExchange" in plan


def test_hot_shares_beyond_the_byte_bound_leave_the_broadcast(spark, lines_df):
    hubs = ["H" * 3000 + str(k) for k in range(5)]  # long titles, many links
    lines = [f"<title>{h}</title>" + " ".join(f"[[t{(i * (k + 1)) % 60}]]" for i in range(80)) for k, h in enumerate(hubs)]
    lines += [f"<title>t{i}</title>[[{hubs[i % 5]}]] [[t{i + 1}]]" for i in range(60)]
    run = lambda **kw: job.rank_pages(lines_df(lines), 4, 0.15, num_partitions=4, **kw)
    plain, small, large = run(), run(hot_floor=1), run(hot_floor=1, hot_broadcast_bytes=5 * 3000)
    assert plain.layout.n_hot == 0 and small.layout.n_hot >= 5 and not small.layout.salted and large.layout.salted
    ranks = lambda res: {r.title: r.rank for r in res.ranks().collect()}
    assert ranks(small) == pytest.approx(ranks(plain), abs=1e-15) and ranks(large) == pytest.approx(ranks(plain), abs=1e-15)
    with job_conf(spark, job.job_settings(4)):
        top = without_cached_builds(plan_of(rank_step(large.layout, large.state, RankConstants.of(0.15, large.n_lines))))
    # hashes are broadcast, titles aren't; shares with salts and the contributions are shuffled
    assert all("bigint" in x for x in top.splitlines() if "BroadcastExchange" in x)
    assert top.count("BroadcastExchange") == 1 and top.count("Exchange hashpartitioning") == 2
    flows = lambda res: sorted((r.src, r.dst, r.mult, r.share) for r in join_sources(res.layout, shares(res.state)).collect())
    assert [x[:3] for x in flows(large)] == [x[:3] for x in flows(plain)]
    spread = large.layout.hot_edges.groupBy("src").agg({"salt": "max"}).collect()
    assert max(r[1] for r in spread) > 0


def test_edges_are_shuffled_once_from_parse_to_layout(spark):
    lines = X.lines(spark, SF, "wp")
    cached = job.rank_pages(lines, 0, 0.15, reliable_graph=False)
    build = plan_of(cached.layout.cold_edges)
    assert build.split("InMemoryTableScan [title")[0].count("Exchange") == 1
    written = job.rank_pages(lines, 0, 0.15)
    with job_conf(spark, job.job_settings(written.layout.num_partitions)):
        for df in (written.layout.cold_edges, written.layout.nodes):
            plan = plan_of(df)
            assert "Exchange" not in plan and "Bucketed: true" in plan
    assert sorted(map(tuple, cached.layout.cold_edges.collect())) == sorted(map(tuple, written.layout.cold_edges.collect()))


def test_partitions_follow_lines_and_bytes_too(spark):
    floor = spark.sparkContext.defaultParallelism
    p = lambda *sizes: job._partitions(spark, None, job.GraphStats(*sizes))
    assert p(10, 20, 30) == floor and job._partitions(spark, 3, job.GraphStats(10**12, 0)) == 3
    assert p(10**10, 0, 0) == 5000 and p(0, 10**10, 0) == 5000 and p(0, 0, 10**12) == 3726


def test_many_vertices_of_a_partition_are_joined_by_merge(spark, monkeypatch):
    monkeypatch.setattr(layout, "HASHED_VERTICES", 10)
    plan, res = step_plan(spark)
    top = without_cached_builds(plan)
    assert res.layout.join_hint == "merge" and "ShuffledHashJoin" not in top and "SortMergeJoin" in top
    assert top.count("Exchange hashpartitioning") == 1


def test_scan_prunes_to_needed_columns(spark):
    df = X.lines(spark, SF, "wd")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan


def test_graph_build_uses_partial_aggregation(spark):
    res = job.rank_pages(X.lines(spark, SF, "wp"), 1, 0.15, reliable_graph=False)
    plan = res.layout.cold_edges._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan
    nodes_plan = res.layout.nodes._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in nodes_plan
    above_parse = nodes_plan.split("InMemoryTableScan [title")[0]
    assert above_parse.count("Exchange") == 1  # vertex closure + out-degree in one aggregate


def test_cache_only_graph_keeps_layout(spark):
    plan, res = step_plan(spark, reliable_graph=False)
    top = without_cached_builds(plan)
    assert top.count("Exchange hashpartitioning") == 1


def test_long_runs_keep_plans_linear(spark):
    # 24 steps without an intermediate checkpoint, hot sources included: each
    # step reads its predecessor once, so planning stays linear (this would
    # not finish if the plan doubled per step).
    import time

    t0 = time.time()
    res = job.rank_pages(X.lines(spark, SF, "wp"), 24, 0.15, checkpoint_every=None, hot_floor=1, hot_factor=64)
    assert res.layout.n_hot > 0
    assert time.time() - t0 < 180
    ref = job.rank_pages(X.lines(spark, SF, "wp"), 24, 0.15, checkpoint_every=6)
    a = {r.title: r.rank for r in res.ranks().collect()}
    b = {r.title: r.rank for r in ref.ranks().collect()}
    assert a == pytest.approx(b, rel=1e-12)

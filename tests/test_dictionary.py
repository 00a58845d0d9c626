"""Jobs on numbers in place of titles: the same ranks, no title in a step, whole hot titles."""

import pytest

from surfrank import fixtures as X
from surfrank.operators.rank import RankConstants, rank_step
from surfrank.plans import dictionary, job
from surfrank.plans.presets import get_preset
from surfrank.session import job_conf
from surfrank.sources import state as ST
from surfrank.sources import text as TX
from surfrank.sources.sinks import read_ranked
from test_plans import plan_of, without_cached_builds

SF = "/root/testdata/sf0.001"


def ranks(res):
    return {r.title: r.rank for r in res.ranks().collect()}


@pytest.mark.parametrize("preset", ["mapreduce", "rdd_py", "rdd_jvm"])
def test_same_ranks_as_with_titles(spark, lines_df, preset):
    lines = [f"<title>p{i}</title><text>[[p{i * 7 % 30}]] [[x{i % 4}]] [[p{i * 7 % 30}]] [[ü {i % 3}]]</text>" for i in range(30)]
    lines += ["<title>p3</title><text>[[p4]]</text>", "<title>alone</title><text></text>"]
    lines += ["<title>p5</title><text>[[]] [[p1]]</text>"]
    df = lines_df(lines)
    run = lambda **kw: job.rank_pages(df, 3, 0.15, preset, num_partitions=3, **kw)
    plain = ranks(run())
    assert ranks(run(dictionary=True)) == pytest.approx(plain, abs=1e-15)
    hot = run(dictionary=True, hot_floor=1, hot_factor=100)
    assert hot.layout.n_hot > 0 and ranks(hot) == pytest.approx(plain, abs=1e-15)
    assert ranks(run(dictionary=True, hot_floor=1, hot_factor=100, hot_broadcast_bytes=0, reliable_graph=False)) == pytest.approx(plain, abs=1e-15)


def test_no_step_and_no_edge_table_holds_a_title(spark):
    trace = []
    res = job.rank_pages(X.lines(spark, SF, "wp"), 2, 0.15, trace=trace, dictionary=True)
    assert [t for _, t in res.layout.cold_edges.dtypes] == ["bigint"] * 3
    with job_conf(spark, job.job_settings(res.layout.num_partitions)):
        step = rank_step(res.layout, trace[-1][1], RankConstants.of(0.15, res.n_lines))
        assert "string" not in {t for _, t in step.dtypes}
        top = without_cached_builds(plan_of(step))
    assert top.count("Exchange hashpartitioning") == 1 and "title" not in top
    n = res.layout.titles.selectExpr("count(DISTINCT id)", "count(DISTINCT title)", "count(*)").first()
    assert n[0] == n[1] == n[2] == res.layout.n_vertices


def test_links_of_a_hot_title_are_spread(spark, lines_df):
    lines = [f"<title>p{i}</title>[[hub]] [[p{i + 1}]]" for i in range(200)] + ["<title>hub</title>" + "".join(f"[[p{i}]]" for i in range(200))]
    preset = get_preset("mapreduce")
    pages = dictionary.G.parsed_ok(dictionary.G.parse_pages(lines_df(lines), preset))
    with job_conf(spark, job.job_settings(4)):
        got = dictionary.number_graph(pages, preset, 600, 4, 100, 20)
        names = {r.id: r.title for r in got.titles.collect()}
        links = sorted((names[r.src], names[r.dst], r.mult) for r in got.links.collect())
        rows = pages.selectExpr("title AS src", "explode(outlinks) AS dst").groupBy("src", "dst").count()
        hot = got.titles.where("indeg > 20").selectExpr("xxhash64(title) AS src_hash", "10 AS salts")
        plan = plan_of(dictionary.number_ends(rows, "dst", "d", "src", got.titles, hot, "salts", "merge"))
    assert links == sorted((r.src, r.dst, r["count"]) for r in rows.collect()) and len(links) == 600
    assert "dst#" in plan and "salt#" in plan
    # what is broadcast is hashes and salts, never titles
    assert all("string" not in x for x in plan.splitlines() if "BroadcastExchange" in x)


def test_an_empty_dump(spark, lines_df):
    res = job.rank_pages(lines_df([]), 2, 0.15, "rdd_py", dictionary=True)
    assert res.ranks().count() == 0


def test_kept_numbers_have_their_titles_beside_them(spark, scratch):
    src, kept, other, plain = scratch(), scratch(), scratch(), scratch()
    TX.write_lines(X.lines(spark, SF, "wd"), src)
    job.run_job(spark, src, kept, 2, 0.15, keep_state=True, dictionary=True)
    job.run_job(spark, src, plain, 2, 0.15, keep_state=True)
    nodes, edges = ST.read_kept(spark, f"{kept}/rank-1")
    assert nodes.schema["id"].dataType.typeName() == "long" and edges.schema["dst"].dataType.typeName() == "long"
    for a, b in zip(ST.read_titled(spark, f"{kept}/rank-1"), ST.read_titled(spark, f"{plain}/rank-1")):
        assert a.drop("rank").exceptAll(b.drop("rank")).count() == b.drop("rank").exceptAll(a.drop("rank")).count() == 0
    text = scratch()
    ST.export_state(spark, f"{kept}/rank-1", text)
    assert ST.read_state(spark, text).count() == nodes.count()
    # goes on in a folder of its own, with titles of its own, and from there again
    job.run_job(spark, None, other, 1, 0.15, resume_from=f"{kept}/rank-0", keep_state=True)
    again = scratch()
    job.run_job(spark, None, again, 0, 0.15, resume_from=f"{other}/rank-1")
    for out in (other, again):
        got, want = read_ranked(spark, f"{out}/sort"), read_ranked(spark, f"{plain}/sort")
        a, b = ({r.title: r.rank for r in x.collect()} for x in (got, want))
        assert a == pytest.approx(b, abs=1e-15)
    with pytest.raises(ValueError):
        job.run_job(spark, src, scratch(), 1, 0.15, keep_state=True, dictionary=True, state_format="text")

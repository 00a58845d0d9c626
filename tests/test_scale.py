"""What keeps a job's tasks and its graph build from growing with the input."""

from surfrank import fixtures
from surfrank.operators import graph as G
from surfrank.plans import job
from surfrank.plans.dictionary import degrees
from surfrank.plans.presets import get_preset

from conftest import DIRTY


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_few_partitions_count_links_in_many_parts(spark, lines_df, monkeypatch):
    lines = [f"<title>p{k}</title>[[p{k + 1}]] [[p{k * 7 % 50}]] [[p{k + 1}]]" for k in range(60)]
    want = job.rank_pages(lines_df(lines), 3, num_partitions=2)
    parts = []
    frame = type(want.state)
    plain = frame.repartition
    monkeypatch.setattr(frame, "repartition", lambda df, n, *c: (parts.append((n, c)), plain(df, n, *c))[1])
    monkeypatch.setattr(job, "LINKS_PER_PARTITION", 20)
    res = job.rank_pages(lines_df(lines), 3, num_partitions=2)
    assert res.layout.num_partitions == 2 and parts == [(9, ("src",)), (2, ("src",))]
    assert {r["title"]: round(r["rank"], 12) for r in res.ranks().collect()} == {r["title"]: round(r["rank"], 12) for r in want.ranks().collect()}


def test_no_lambda_looks_at_each_link(spark, lines_df):
    """Lambdas run outside of generated code: a page's links are counted by one, but no row is made by one."""
    for name in ("mapreduce", "rdd_py"):
        preset = get_preset(name)
        pages = G.parsed_ok(G.parse_pages(lines_df(DIRTY), preset))
        assert "lambda" not in _plan(G.parse_pages(lines_df(DIRTY), preset))
        assert "lambda" not in _plan(G.link_occurrences(pages, preset))
        assert "struct" not in _plan(G.nodes(pages, preset)) + _plan(degrees(pages, preset))


def test_degrees_of_odd_links(spark):
    pages = spark.createDataFrame([("a", ["", "b", "b", None]), ("a", []), ("c", ["a"]), ("d", None)], "title string, outlinks array<string>")
    mr, py = get_preset("mapreduce"), get_preset("rdd_py")
    assert {r["id"]: r["outdeg"] for r in G.nodes(pages, mr).collect()} == {"a": 2, "": 0, "b": 0, None: 0, "c": 1}
    assert {r["id"]: r["outdeg"] for r in G.nodes(pages, py).collect()} == {"a": 4, "": 0, "b": 0, None: 0, "c": 1}
    assert sorted(r["dst"] for r in G.link_occurrences(pages, mr).collect()) == ["a", "b", "b"]
    assert {r["title"]: (r["outdeg"], r["indeg"]) for r in degrees(pages, mr).collect()} == {"a": (2, 1), "": (0, 1), "b": (0, 2), None: (0, 1), "c": (1, 0)}


def test_hot_pages_are_split_before_their_links_are_made(spark, lines_df):
    lines = [f"<title>HUB</title>[[p{k}]] [[p{k + 1}]]" for k in range(30)] + [f"<title>p{k}</title>[[HUB]] [[]]" for k in range(30)]
    kw = dict(iterations=3, num_partitions=3)
    hot, salted, plain = (job.rank_pages(lines_df(lines), **kw, **o) for o in (dict(hot_floor=10), dict(hot_floor=10, hot_broadcast_bytes=0), {}))
    assert hot.layout.n_hot == salted.layout.n_hot == 1 and salted.layout.salted and plain.layout.n_hot == 0
    want = {r["title"]: round(r["rank"], 12) for r in plain.ranks().collect()}
    for res in (hot, salted):
        assert {r["title"]: round(r["rank"], 12) for r in res.ranks().collect()} == want
        assert sorted(map(tuple, res.layout.edges().collect())) == sorted(map(tuple, plain.layout.edges().collect()))


def test_links_of_a_part_are_joined_in_order(spark, tmp_path):
    spark.createDataFrame([(1, 1, 5, 0), (1, 2, 6, 0), (1, 2, 7, 0), (2, 1, 5, 0), (2, 2, None, 0), (3, 1, 8, 0), (3, 2, None, 0), (0, 1, 5, 0), (0, 2, 9, 0)], "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(5,), (8,), (9,)], "p_partkey long").write.parquet(f"{tmp_path}/part.parquet")
    lines = sorted(r["value"] for r in fixtures.wp_lines(spark, str(tmp_path)).collect())
    page = "<page><title>P{}</title><text>{}</text></page>".format
    assert lines == [page(5, "[[P9]] [[P6]] [[P7]]"), page(8, ""), page(9, "")]

"""

Every query reads the driver tables, derives page lines from them (see
``surfrank.fixtures``: WP part graph, WH web-page graph, WD dirty lines, WK with a hot page, WS with line separators) and
runs one operator of the ranking engine over the whole derived input.  Each
has a DuckDB twin built from the same lines with independent SQL
(``surfrank.oracle``).  Doubles are reported on a 2**-40 grid; outputs with an
order carry a ``pos`` column so an order-insensitive hash still checks order.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from surfrank import fixtures as X  # noqa: E402
from surfrank import oracle as O  # noqa: E402
from surfrank.functions import extract as E  # noqa: E402
from surfrank.functions import render as R  # noqa: E402
from surfrank.operators import graph as G  # noqa: E402
from surfrank.operators import rank as K  # noqa: E402
from surfrank.operators.order import distinct_ranked, order_ranked, with_position  # noqa: E402
from surfrank.plans.job import rank_pages, ranking_output, resume_from_records, run_job  # noqa: E402
from surfrank.plans.presets import get_preset  # noqa: E402
from surfrank.session import scratch_path  # noqa: E402
from surfrank.sources import sinks as SK  # noqa: E402
from surfrank.sources import state as ST  # noqa: E402
from surfrank.sources import text as TX  # noqa: E402

try:
    import corpus_pipeline
    from surfrank.llm import queries as training_data
except ImportError as e:  # the training-data operators are optional; only this module may do without them
    if e.name not in ("corpus_pipeline", "surfrank.llm"):
        raise  # anything else that they lack is an error
    corpus_pipeline = training_data = None

ALPHA = 0.15
SCALE = float(O.RANK_SCALE)
SEP = "\u001f"  # joins link lists into one comparable string
FLAGSHIP_SF = "/root/testdata/sf0.001"


def _q(c: F.Column) -> F.Column:
    """Quantise a double to the 2**-40 grid shared with the SQL twins."""
    return F.round(c * F.lit(SCALE)) / F.lit(SCALE)


def _r(c: str) -> F.Column:
    return _q(F.col(c))


def _lines(spark, sf, fx):
    return X.lines(spark, sf, fx)


def _rank(spark, sf, fx, preset, iterations, **kw):
    return rank_pages(_lines(spark, sf, fx), iterations=iterations, alpha=ALPHA, preset=preset, **kw)


def _ranks_out(result, title="title"):
    """(title, rank) of the final state.  The state is its own checkpoint, so the
    layout (cached tables, written graph copy) is released right away."""
    out = result.state.select(F.col("id").alias(title), _r("rank").alias("rank"))
    result.layout.release()
    return out


def _settled(df, result):
    """``df`` written to the shared folder and read back, so that the layout it was made from can be released."""
    path = scratch_path(df.sparkSession, "result")
    df.write.parquet(path)
    result.layout.release()
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _graph(spark, sf, fx, preset):
    """pages, edges, nodes and N of a fixture, straight from the graph operators."""
    p = get_preset(preset)
    lines = _lines(spark, sf, fx)
    parsed = G.parse_pages(lines, p)
    n = TX.page_count(lines).first()["n_lines"]
    pages = G.parsed_ok(parsed)
    return p, pages, G.edges(pages, p), G.nodes(pages, p), int(n)


def _joined(c):
    return F.array_join(c, SEP)


# ---------------------------------------------------------------- sources/sinks
def q_scan_lines(spark, sf):
    path = scratch_path(spark, "scan-lines")
    TX.write_lines(_lines(spark, sf, "wp"), path)
    return TX.read_lines(spark, path)


def q_page_count(spark, sf):
    parts = [TX.page_count(_lines(spark, sf, fx)).select(F.lit(fx).alias("fixture"), "n_lines") for fx in X.FIXTURES]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def q_sink_count_line(spark, sf):
    path = scratch_path(spark, "count")
    TX.write_count(_lines(spark, sf, "wd"), path)
    return spark.read.text(path).select("value", TX.parse_count("value").alias("n_lines"))


# ---------------------------------------------------------------- extraction
def q_title_regex(spark, sf):
    return _lines(spark, sf, "wd").select("value", E.title_regex("value").alias("title"))


def q_title_positional(spark, sf):
    return _lines(spark, sf, "wd").select(
        "value",
        E.title_positional("value", "slice").alias("title_slice"),
        E.title_positional("value", "skip").alias("title_strict"),
    )


def q_outlinks(spark, sf):
    out = None
    for fx in ("wd", "wp"):
        df = _lines(spark, sf, fx).select(
            "value",
            F.size(E.outlinks("value", "java")).cast("long").alias("n_links"),
            _joined(E.outlinks("value", "java")).alias("links"),
            F.size(E.outlinks("value", "newline_only")).cast("long").alias("n_links_py"),
        )
        out = df if out is None else out.unionByName(df)
    return out


def q_outlinks_dot_rules(spark, sf):
    """Lines with U+0085, U+2028 and U+2029, at which one rule's dot stops and the other's doesn't."""
    return _lines(spark, sf, "ws").select(
        "value", E.title_regex("value").alias("title"), _joined(E.outlinks("value", "java")).alias("links_java"), _joined(E.outlinks("value", "newline_only")).alias("links_py")
    )


def q_normalize_tabs(spark, sf):
    p = get_preset("mapreduce")
    lines = _lines(spark, sf, "wd")
    return lines.select("value", E.page_title("value", p).alias("title"), _joined(E.page_links("value", p)).alias("links"))


def q_outlinks_text_scope(spark, sf):
    out = None
    for fx in ("wp", "wd"):
        links = E.outlinks_text_scope("value")
        df = _lines(spark, sf, fx).select(
            "value", F.size(links).cast("long").alias("n_links"), _joined(links).alias("links")
        )
        out = df if out is None else out.unionByName(df)
    return out


def q_parse_pages(spark, sf):
    parsed = G.parsed_ok(G.parse_pages(_lines(spark, sf, "wd"), get_preset("mapreduce")))
    return parsed.select("title", F.size("outlinks").cast("long").alias("n_links"), _joined("outlinks").alias("links"))


# ---------------------------------------------------------------- graph
def q_adjacency_mr(spark, sf):
    _, _, edges, _, _ = _graph(spark, sf, "wd", "mapreduce")
    return edges


def q_edges_mr(spark, sf):
    """(page, link), (link, '') and (page without links, '') with their numbers, from the merged link multiset."""
    pages = G.parsed_ok(G.parse_pages(_lines(spark, sf, "wd"), get_preset("mapreduce")))
    entries = G.adjacency_entries(pages)
    alone = pages.where(F.size("outlinks") == 0).select(F.col("title").alias("key"), F.lit("").alias("value"), F.lit(1).cast("long").alias("n"))
    rows = entries.toDF("key", "value", "n").unionByName(entries.select(F.col("link").alias("key"), F.lit("").alias("value"), F.col("mult").alias("n"))).unionByName(alone)
    return rows.groupBy("key", "value").agg(F.sum("n").alias("n"))


def q_vertices(spark, sf):
    out = None
    for preset in ("mapreduce", "rdd_py"):
        p = get_preset(preset)
        pages = G.parsed_ok(G.parse_pages(_lines(spark, sf, "wd"), p))
        df = G.vertices(pages).select(F.lit(preset).alias("preset"), "id")
        out = df if out is None else out.unionByName(df)
    return out


def q_edge_multiplicity(spark, sf):
    _, _, edges, _, _ = _graph(spark, sf, "wp", "mapreduce")
    return edges


def q_out_degree(spark, sf):
    out = None
    for preset in ("mapreduce", "rdd_py"):
        _, _, _, nodes, _ = _graph(spark, sf, "wd", preset)
        df = nodes.select(F.lit(preset).alias("preset"), "id", "outdeg")
        out = df if out is None else out.unionByName(df)
    return out


def q_dangling_nodes(spark, sf):
    out = None
    for preset in ("mapreduce", "rdd_py"):
        _, _, _, nodes, _ = _graph(spark, sf, "wd", preset)
        df = G.dangling_nodes(nodes).select(F.lit(preset).alias("preset"), "id")
        out = df if out is None else out.unionByName(df)
    return out


def q_adjacency(spark, sf):
    pages = G.parsed_ok(G.parse_pages(_lines(spark, sf, "wh"), get_preset("rdd_py")))
    return G.adjacency_entries(pages)


# ---------------------------------------------------------------- one step
def q_initial_rank(spark, sf):
    p, _, _, nodes, n = _graph(spark, sf, "wd", "mapreduce")
    state = K.initial_rank(nodes, K.RankConstants.of(ALPHA, n, p.alpha_precision))
    return state.select("id", _r("rank").alias("rank"))


def q_zero_mass(spark, sf):
    _, _, _, nodes, _ = _graph(spark, sf, "wd", "rdd_py")
    return K.zero_mass(nodes).withColumnRenamed("c", "mass")


def q_contributions(spark, sf):
    res = _rank(spark, sf, "wp", "mapreduce", 0)
    flows = K.join_sources(res.layout, K.shares(res.state))
    return _settled(flows.select("src", "dst", _q(F.col("mult") * F.col("share")).alias("c")), res)


def q_adjacency_with_rank(spark, sf):
    res = _rank(spark, sf, "wp", "mapreduce", 0)
    ranks = res.state.select(F.col("id").alias("src"), "rank")
    return _settled(K.join_sources(res.layout, ranks).select("src", "dst", "mult", _r("rank").alias("rank")), res)


def q_rank_sum(spark, sf):
    res = _rank(spark, sf, "wp", "mapreduce", 0)
    flows = K.join_sources(res.layout, K.shares(res.state))
    contrib = flows.select("dst", (F.col("mult") * F.col("share")).alias("c"))
    sums = K.contribution_sums_with_zero(contrib, res.layout.nodes)
    return _settled(sums.select("id", _r("s").alias("s")), res)


def q_rank_step(spark, sf):
    return _ranks_out(_rank(spark, sf, "wd", "mapreduce", 1), "id")


def q_rank_float32(spark, sf):
    return _ranks_out(_rank(spark, sf, "wh", "rdd_jvm", 3), "id")


# ---------------------------------------------------------------- state records
def _records(spark, sf, fx, preset, iterations):
    res = _rank(spark, sf, fx, preset, iterations)
    return ST.layout_records(res.state, res.layout), res


def _records_out(records):
    return records.select(
        "title",
        _r("pageRank").alias("pageRank"),
        F.size("adjacencyList").cast("long").alias("n_links"),
        _joined(F.array_sort("adjacencyList")).alias("links"),
        "isNode",
    )


def q_initial_state(spark, sf):
    records, res = _records(spark, sf, "wp", "mapreduce", 0)
    return _settled(_records_out(records), res)


def q_state_lines(spark, sf):
    records, res = _records(spark, sf, "wd", "mapreduce", 0)
    path = scratch_path(spark, "state")
    ST.write_state(records, path)
    res.layout.release()
    return _records_out(ST.read_state(spark, path))


def q_ranks_from_state(spark, sf):
    records, res = _records(spark, sf, "wd", "mapreduce", 1)
    path = scratch_path(spark, "state")
    ST.write_state(records, path)
    res.layout.release()
    return ST.ranks_from_records(ST.read_state(spark, path)).select("title", _r("rank").alias("rank"))


def q_state_roundtrip(spark, sf):
    records, res = _records(spark, sf, "wd", "mapreduce", 2)
    path = scratch_path(spark, "state")
    ST.write_state(records, path)
    res.layout.release()
    resumed = resume_from_records(ST.read_state(spark, path), res.n_lines, 2, ALPHA)
    return _ranks_out(resumed)


def q_rank_messages(spark, sf):
    """What each page gets from its links: shares and how many of them, from the layout's join."""
    res = _rank(spark, sf, "wd", "mapreduce", 0)
    flows = K.join_sources(res.layout, K.shares(res.state))
    return _settled(flows.groupBy(F.col("dst").alias("key"), _r("share").alias("share")).agg(F.sum("mult").alias("n")), res)


def q_split_state(spark, sf):
    """Every page with the number and sum of the shares that it gets, zero for pages without in-links."""
    res = _rank(spark, sf, "wd", "mapreduce", 0)
    flows = K.join_sources(res.layout, K.shares(res.state))
    got = flows.groupBy(F.col("dst").alias("id")).agg(F.sum("mult").alias("n_messages"), F.sum(F.col("mult") * F.col("share")).alias("msg_sum"))
    both = res.layout.nodes.join(got, "id", "left").select(
        F.col("id").alias("key"),
        F.lit(1).cast("long").alias("n_structure"),
        F.coalesce("n_messages", F.lit(0)).alias("n_messages"),
        _q(F.coalesce("msg_sum", F.lit(0.0))).alias("msg_sum"),
    )
    return _settled(both, res)


# ---------------------------------------------------------------- loop, order, sinks
def q_rank_10(spark, sf):
    return _ranks_out(_rank(spark, sf, "wp", "mapreduce", 10))


def q_ranked(spark, sf):
    res = _rank(spark, sf, "wp", "mapreduce", 10)
    ordered = order_ranked(_ranks_out(res))
    return with_position(ordered).select("pos", "title", "rank")


def q_rank_trace(spark, sf):
    # each state is written while it is cached, so no step runs again for the trace
    path = scratch_path(spark, "trace")

    def keep(i, state):
        state.select(F.lit(i).cast("long").alias("iteration"), "id", _r("rank").alias("rank")).write.mode("append").parquet(path)

    _rank(spark, sf, "wp", "mapreduce", 3, on_state=keep).layout.release()
    return spark.read.parquet(path)


def q_rank_partitions(spark, sf):
    out = None
    for n in (2, 7):
        res = _rank(spark, sf, "wp", "mapreduce", 5, num_partitions=n)
        df = _ranks_out(res).select(F.lit(n).cast("long").alias("num_partitions"), "title", "rank")
        out = df if out is None else out.unionByName(df)
    return out


def _sink_roundtrip(spark, sf, fx, preset, iterations, fmt):
    res = _rank(spark, sf, fx, preset, iterations)
    path = scratch_path(spark, f"ranking-{fmt}")
    SK.write_ranked(res.ranked(), path, fmt)
    res.layout.release()
    return SK.read_ranked(spark, path, fmt).select("title", _r("rank").alias("rank"))


def q_sink_ranked_tsv(spark, sf):
    return _sink_roundtrip(spark, sf, "wd", "mapreduce", 4, "tsv")


def q_sink_tuple_py(spark, sf):
    return _sink_roundtrip(spark, sf, "wd", "rdd_py", 4, "tuple_py")


def q_sink_tuple_jvm(spark, sf):
    return _sink_roundtrip(spark, sf, "wh", "rdd_jvm", 4, "tuple_jvm")


def q_sink_ranked_order(spark, sf):
    """The order of lines in the sinks: files by name, lines as they stand (O3), in each form."""
    ranked = order_ranked(_ranks_out(_rank(spark, sf, "wd", "mapreduce", 4)))
    out = None
    for fmt in SK.FORMATS:
        path = scratch_path(spark, f"order-{fmt}")
        SK.write_ranked(ranked, path, fmt)
        meta = F.col("_metadata")
        lines = spark.read.text(path).select(
            "value", meta["file_name"].alias("f"), meta["file_block_start"].alias("b"), F.monotonically_increasing_id().alias("m")
        )
        placed = with_position(lines.orderBy("f", "b", "m"))
        parsed = {"tsv": R.parse_tsv, "tuple_jvm": R.parse_tuple_jvm}
        if fmt in parsed:
            df = placed.select("pos", *parsed[fmt]("value"))
        else:
            df = placed.select("pos", R.parse_tuple_py(F.col("value")).alias("p")).select("pos", "p.title", "p.rank")
        df = df.select(F.lit(fmt).alias("form"), "pos", "title", _r("rank").alias("rank"))
        out = df if out is None else out.unionByName(df)
    return out


JOB_RUNS = O.JOB_RUNS


def _job(spark, sf, preset):
    out = None
    for fx, its in JOB_RUNS[preset]:
        src = scratch_path(spark, f"input-{fx}")
        TX.write_lines(_lines(spark, sf, fx), src)
        dst = scratch_path(spark, f"job-{preset}")
        run_job(spark, src, dst, its, ALPHA, preset)
        back = SK.read_ranked(spark, ranking_output(dst, preset), get_preset(preset).output_format)
        df = back.select(F.lit(fx).alias("fixture"), "title", _r("rank").alias("rank"))
        out = df if out is None else out.unionByName(df)
    return out


def q_job_mapreduce(spark, sf):
    return _job(spark, sf, "mapreduce")


def q_job_rdd_jvm(spark, sf):
    return _job(spark, sf, "rdd_jvm")


def q_job_rdd_py(spark, sf):
    return _job(spark, sf, "rdd_py")


def _resumed(spark, sf, fx, state_format, **options):
    """Two steps kept, then two more from the kept folder."""
    src, dst = scratch_path(spark, f"input-{fx}"), scratch_path(spark, "job-kept")
    TX.write_lines(_lines(spark, sf, fx), src)
    run_job(spark, src, dst, 2, ALPHA, "mapreduce", keep_state=True, state_format=state_format, **options)
    again = scratch_path(spark, "job-resumed")
    run_job(spark, None, again, 2, ALPHA, "mapreduce", resume_from=f"{dst}/rank-1", **options)
    return SK.read_ranked(spark, ranking_output(again, "mapreduce"), "tsv").select("title", _r("rank").alias("rank"))


def q_job_resumed(spark, sf):
    """Through the kept tables of nodes and edges, with a hot page."""
    return _resumed(spark, sf, "wk", "parquet", hot_floor=HOT_FLOOR)


def q_job_resumed_text(spark, sf):
    """Through graph-state records."""
    return _resumed(spark, sf, "wd", "text")


def q_kept_state(spark, sf):
    """Nodes of the second kept step with the edges that all steps share."""
    src, dst = scratch_path(spark, "input-wk"), scratch_path(spark, "job-kept")
    TX.write_lines(_lines(spark, sf, "wk"), src)
    run_job(spark, src, dst, 2, ALPHA, "mapreduce", keep_state=True, hot_floor=HOT_FLOOR)
    nodes, edges = ST.read_kept(spark, f"{dst}/rank-1")
    return nodes.join(edges, nodes["id"] == edges["src"], "left").select("id", "outdeg", _r("rank").alias("rank"), "dst", "mult")


def q_ranked_repeated(spark, sf):
    """Order of a state in which records come several times, as raw parts of a kept folder may."""
    ranks = _ranks_out(_rank(spark, sf, "wd", "mapreduce", 2))
    repeated = ranks.unionByName(ranks.where(F.crc32("title") % 3 > 0)).unionByName(ranks.where(F.crc32("title") % 3 > 1))
    return with_position(order_ranked(distinct_ranked(repeated))).select("pos", "title", "rank")


def q_rank_extractor(spark, sf):
    """A caller's title and link rules: those of mapreduce, plugged into a preset that has others."""
    mr, py = get_preset("mapreduce"), get_preset("rdd_py").with_options(blank_links="marker")
    rule = lambda line: (E.page_title(line, mr), E.page_links(line, mr))
    return _ranks_out(_rank(spark, sf, "wd", py, 3, extractor=rule))


#: Links from which on a page may be hot, for inputs far smaller than those that the default is for.
HOT_FLOOR = 500


def _hot_rank(spark, sf, iterations, **options):
    """Ranks of the graph with a hot page.  Only the floor is lowered: the bound on hot pages is that of any job."""
    res = _rank(spark, sf, "wk", "mapreduce", iterations, hot_floor=HOT_FLOOR, **options)
    if not 0 < res.layout.n_hot < res.layout.n_vertices:
        raise AssertionError(f"{res.layout.n_hot} of {res.layout.n_vertices} sources are hot: one kind is missing")
    return res


def q_rank_10_hot_sources(spark, sf):
    return _ranks_out(_hot_rank(spark, sf, 10))


def q_rank_salted_sources(spark, sf):
    """The same with the byte bound at 0: the hot page's edges are salted and its shares aren't broadcast."""
    res = _hot_rank(spark, sf, 3, hot_broadcast_bytes=0)
    if not res.layout.salted:
        raise AssertionError("the shares were broadcast")
    return _ranks_out(res)


def q_rank_dictionary(spark, sf):
    """Steps on numbers; the hot page's links get theirs by salted joins."""
    res = _hot_rank(spark, sf, 3, dictionary=True)
    if dict(res.layout.cold_edges.dtypes)["src"] != "bigint":
        raise AssertionError("the edges hold titles")
    return _ranks_out(res)


def q_job_resumed_dictionary(spark, sf):
    """Through kept tables of numbers, with the titles beside them."""
    return _resumed(spark, sf, "wk", "parquet", hot_floor=HOT_FLOOR, dictionary=True)


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "scan_lines": q_scan_lines,
    "page_count": q_page_count,
    "sink_count_line": q_sink_count_line,
    "title_regex": q_title_regex,
    "title_positional": q_title_positional,
    "outlinks": q_outlinks,
    "outlinks_dot_rules": q_outlinks_dot_rules,
    "normalize_tabs": q_normalize_tabs,
    "outlinks_text_scope": q_outlinks_text_scope,
    "parse_pages": q_parse_pages,
    "adjacency_mr": q_adjacency_mr,
    "edges_mr": q_edges_mr,
    "vertices": q_vertices,
    "edge_multiplicity": q_edge_multiplicity,
    "out_degree": q_out_degree,
    "dangling_nodes": q_dangling_nodes,
    "adjacency": q_adjacency,
    "initial_rank": q_initial_rank,
    "zero_mass": q_zero_mass,
    "contributions": q_contributions,
    "adjacency_with_rank": q_adjacency_with_rank,
    "rank_sum": q_rank_sum,
    "rank_step": q_rank_step,
    "rank_float32": q_rank_float32,
    "initial_state": q_initial_state,
    "state_lines": q_state_lines,
    "ranks_from_state": q_ranks_from_state,
    "state_roundtrip": q_state_roundtrip,
    "rank_messages": q_rank_messages,
    "split_state": q_split_state,
    "rank_10": q_rank_10,
    "ranked": q_ranked,
    "rank_trace": q_rank_trace,
    "rank_partitions": q_rank_partitions,
    "sink_ranked_tsv": q_sink_ranked_tsv,
    "sink_tuple_py": q_sink_tuple_py,
    "sink_tuple_jvm": q_sink_tuple_jvm,
    "job_mapreduce": q_job_mapreduce,
    "job_rdd_jvm": q_job_rdd_jvm,
    "job_rdd_py": q_job_rdd_py,
    "rank_10_hot_sources": q_rank_10_hot_sources,
    "sink_ranked_order": q_sink_ranked_order,
    "job_resumed": q_job_resumed,
    "rank_extractor": q_rank_extractor,
    "rank_salted_sources": q_rank_salted_sources,
    "kept_state": q_kept_state,
    "job_resumed_text": q_job_resumed_text,
    "ranked_repeated": q_ranked_repeated,
    "rank_dictionary": q_rank_dictionary,
    "job_resumed_dictionary": q_job_resumed_dictionary,
}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: rank the WP page graph of sf0.001 for 10 steps, highest first."""
    res = _rank(spark, FLAGSHIP_SF, "wp", "mapreduce", 10)
    ranked = res.ranked()
    res.layout.release()  # the final state is its own checkpoint
    return ranked


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out = dict(_QUERIES)
    if training_data is not None:
        out |= training_data.queries()
        out["pipeline"] = corpus_pipeline.run
    return out


def oracle_sql() -> dict[str, str]:
    out = O.all_queries(ALPHA, SEP)
    if training_data is not None:
        out |= training_data.oracle_sql()
        if corpus_pipeline.ORACLE_SQL is not None:
            out["pipeline"] = corpus_pipeline.ORACLE_SQL
    return out

"""Whole ranking jobs: lines -> graph -> k steps -> ordered ranking.

Jobs per run: one pass over the parsed lines for N and the link total; the
graph build (``plans.layout``: node and edge tables written once to the checkpoint folder as
they are partitioned, and cached from there); one job per state checkpoint; then the
caller's final action (global sort, sink).  Each step adds exactly one shuffle
(the contribution sums by target), because the node table, the state and the
regular edges share one hash layout.

Scale notes
-----------
* N counts every line, so it is taken on the parsed lines (title + links, far
  smaller than the raw text), which are cached for the graph build.
* The number of partitions follows links, lines and bytes.
* The graph tables are written tables in ``spark.checkpoint.dir``; the state's
  lineage is cut by reliable checkpoints every ``checkpoint_every`` steps (and
  after the last one).  A lost executor costs a table re-read plus at most
  ``checkpoint_every`` replayed steps, never a re-parse of the input.
* A kept state is a pair of Parquet tables, nodes(id, outdeg, rank) of each step and edges(src,
  dst, mult) once for all of them; no page's links are ever one row.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surfrank.operators import graph as G
from surfrank.operators.order import order_ranked
from surfrank.operators.rank import RankConstants, RankLayout, initial_rank, rank_step
from surfrank.plans.dictionary import number_graph, with_titles
from surfrank.plans.layout import DEFAULT_HOT_FACTOR, DEFAULT_HOT_FLOOR, HOT_BROADCAST_BYTES, id_bytes, lay_out
from surfrank.plans.presets import Preset, get_preset
from surfrank.session import checkpoint_dir, job_conf, path_exists

@dataclass
class GraphStats:
    n_lines: int
    n_links: int
    n_bytes: int = 0  # of titles and links, each as often as it comes


#: What a partition holds at most, on average: link occurrences, lines, and bytes of titles and links.
LINKS_PER_PARTITION, LINES_PER_PARTITION, BYTES_PER_PARTITION = 2_000_000, 2_000_000, 256 << 20


def _partitions(spark: SparkSession, num_partitions: int | None, stats: GraphStats) -> int:
    """P for the job: explicit, else sized from the graph, at least the cluster's default parallelism.

    The session's number of shuffle partitions is no limit: a
    graph beyond it needs more, smaller partitions.
    """
    if num_partitions is not None:
        if num_partitions < 1:
            raise ValueError("num_partitions must be >= 1")
        return int(num_partitions)
    return max(1, int(spark.sparkContext.defaultParallelism), sized_partitions(stats))


def sized_partitions(stats: GraphStats) -> int:
    """Links, lines (a page without links is a vertex as well) and bytes each set a number of partitions, and the largest is taken."""
    sizes = ((stats.n_links, LINKS_PER_PARTITION), (stats.n_lines, LINES_PER_PARTITION), (stats.n_bytes, BYTES_PER_PARTITION))
    return max(math.ceil(n / most) for n, most in sizes)


def job_settings(num_partitions: int) -> dict[str, str]:
    """Settings for the duration of a job.

    * shuffle partitions = P, so every exchange of a step produces the layout of
      the node state (co-partitioned joins, no re-shuffle of edges or state);
    * no automatic broadcast: the only broadcast is the bounded hot-source one,
      requested explicitly;
    * no adaptive re-planning inside the loop: the layout is planned up front (hot
      sources split, partial sums for hot targets), and a checkpoint taken under
      an adaptive plan forgets its hash layout, which would re-shuffle the state
      twice per step;
    * bucketed tables may have P buckets, and a task that writes one bucket needn't sort its rows.
    """
    return {
        "spark.sql.sources.bucketing.maxBuckets": str(max(100_000, num_partitions)),
        "spark.sql.maxConcurrentOutputFileWriters": "2",
        "spark.sql.shuffle.partitions": str(num_partitions),
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.enabled": "false",
    }


def graph_stats(parsed: DataFrame, preset: Preset) -> GraphStats:
    """N (every line, parsed or not), and the number and bytes of kept link occurrences and titles, in one pass (A1, S3)."""
    kept = G.kept_links(preset)
    here = F.col("title").isNotNull()
    size = F.octet_length("title").cast("long") + F.octet_length(F.array_join("outlinks", ""))
    row = parsed.agg(F.count(F.lit(1)).alias("n"), F.sum(F.when(here, F.size(kept)).cast("long")).alias("links"), F.sum(F.when(here, size)).alias("bytes")).first()
    return GraphStats(int(row["n"]), int(row["links"] or 0), int(row["bytes"] or 0))


def iterate(
    layout: RankLayout,
    consts: RankConstants,
    iterations: int,
    checkpoint_every: int | None = 5,
    checkpoint_last: bool = True,
    start: DataFrame | None = None,
    storage: StorageLevel = StorageLevel.MEMORY_AND_DISK,
    on_state: Callable[[int, DataFrame], None] | None = None,
) -> Iterator[tuple[int, DataFrame]]:
    """Yield (i, state_i) for i = 0..iterations.

    Every state is cached.  Reliable checkpoints every ``checkpoint_every`` steps
    cut the lineage; cached states older than the last checkpoint are released.
    With hot sources a step reads its predecessor twice (regular and hot
    shares), so there every state is checkpointed and plans don't double with
    each step.  ``start`` (id, outdeg, hot, rank; a leaf) resumes from given
    ranks; the default is 1/N everywhere.  ``on_state(i, state)`` runs while
    state i is cached (e.g. to write it out, I2), from i = 0.
    """
    state = initial_rank(layout.nodes, consts) if start is None else start
    if on_state is not None:
        on_state(0, state)
    yield 0, state
    cached: list[DataFrame] = []
    if layout.hot_edges is not None:
        checkpoint_every = 1
    for i in range(1, max(0, iterations) + 1):
        state = rank_step(layout, state, consts).persist(storage)
        cached.append(state)
        if on_state is not None:
            on_state(i, state)
        last = i == iterations
        if (checkpoint_every and i % checkpoint_every == 0) or (last and checkpoint_last):
            state = state.checkpoint(eager=True)
            for df in cached:
                df.unpersist()
            cached = []
        yield i, state


@dataclass
class RankResult:
    """Output of ``rank_pages``: the final state and the layout it ran on."""

    state: DataFrame  # id, outdeg, hot, rank
    layout: RankLayout
    n_lines: int

    def ranks(self) -> DataFrame:
        """(title, rank) for every vertex, unordered."""
        return self.state.select(F.col("id").alias("title"), "rank")

    def ranked(self) -> DataFrame:
        """(title, rank), highest rank first, ties by title (O2)."""
        return order_ranked(self.ranks())


def rank_pages(
    lines: DataFrame,
    iterations: int = 10,
    alpha: float | str = 0.15,
    preset: str | Preset = "mapreduce",
    num_partitions: int | None = None,
    checkpoint_every: int | None = 5,
    column: str = "value",
    hot_factor: int = DEFAULT_HOT_FACTOR,
    hot_floor: int = DEFAULT_HOT_FLOOR,
    trace: list | None = None,
    on_state: Callable[[int, DataFrame], None] | None = None,
    layout_sink: list | None = None,
    reliable_graph: bool = True,
    extractor: G.Extractor | None = None,
    hot_broadcast_bytes: int = HOT_BROADCAST_BYTES,
    dictionary: bool = False,
) -> RankResult:
    """Rank every vertex of the page graph described by ``lines``.

    ``lines`` has one page per row in ``column``.  ``alpha`` is the random-jump
    probability.  The steps run eagerly (checkpointed); the returned object's
    ``ranked()`` is a lazy, globally ordered DataFrame.  When ``trace`` is a
    list, (iteration, state) pairs are appended to it.  ``reliable_graph``
    also writes the node and edge tables to the checkpoint folder once, so a
    lost executor never forces a re-parse of the input.  ``extractor`` replaces
    the preset's title and link rules: line column -> (title, array of links).
    With an explicit ``num_partitions`` that is small for the graph, links are still counted in as many
    parts as their number needs.
    ``hot_factor``, ``hot_floor`` and ``hot_broadcast_bytes``: see ``plans.layout``.
    ``dictionary`` runs the steps on numbers in place of titles (``plans.dictionary``);
    the result has titles, ``trace`` and ``on_state`` get the numbered states, whose titles
    are in the layout's ``titles``.
    """
    preset = get_preset(preset)
    spark = lines.sparkSession
    checkpoint_dir(spark)
    parsed = G.parse_pages(lines, preset, column, extractor).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        stats = graph_stats(parsed, preset)
        if stats.n_lines == 0 and preset.on_empty == "error":
            raise ValueError("empty input: no lines to rank (page count job failed)")
        p = _partitions(spark, num_partitions, stats)
        with job_conf(spark, job_settings(p)):
            pages = G.parsed_ok(parsed)
            numbered = number_graph(pages, preset, stats.n_links, p, hot_factor, hot_floor) if dictionary else None
            options = dict(hot_factor=hot_factor, hot_floor=hot_floor, reliable=reliable_graph, hot_broadcast_bytes=hot_broadcast_bytes)
            if dictionary:
                layout = lay_out(numbered.nodes, numbered.links, stats.n_lines, stats.n_links, p, **options)
            else:
                sources = pages.withColumnRenamed("title", "src")
                each = lambda rows: G.link_occurrences(rows.withColumnRenamed("src", "title"), preset)
                layout = lay_out(G.nodes(pages, preset), sources, stats.n_lines, stats.n_links, p, each=each, count_parts=sized_partitions(stats), **options)
            if dictionary:
                layout = numbered.attach(layout)
    finally:
        parsed.unpersist()
    with job_conf(spark, job_settings(p)):
        if layout_sink is not None:
            layout_sink.append(layout)
        consts = RankConstants.of(alpha, stats.n_lines, preset.alpha_precision)
        state = _run(layout, consts, iterations, checkpoint_every, trace, on_state=on_state)
    return RankResult(state, layout, stats.n_lines)


def _run(layout, consts, iterations, checkpoint_every, trace, start=None, on_state=None) -> DataFrame:
    state = None
    for i, state in iterate(layout, consts, iterations, checkpoint_every, start=start, on_state=on_state):
        if trace is not None:
            trace.append((i, state))
    if layout.titles is not None:
        return with_titles(state, layout).checkpoint(eager=True)
    if iterations <= 0:
        state = state.checkpoint(eager=True)
    return state


def resume_from_records(records: DataFrame, n_lines: int, iterations: int, alpha: float | str = 0.15, alpha_precision: str = "double", **kw) -> RankResult:
    """Continue a ranking from graph-state records (S2 -> I1).  N is a job parameter; ``kw`` as in ``resume_from_tables``."""
    from surfrank.sources.state import graph_from_records

    checkpoint_dir(records.sparkSession)
    records = records.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        nodes_df, edges_df, ranks = graph_from_records(records)
        # a target that no record has as its title starts without a rank
        return resume_from_tables(nodes_df.join(ranks, "id", "left"), edges_df, n_lines, iterations, alpha, alpha_precision, **kw)
    finally:
        records.unpersist()


def resume_from_tables(
    nodes_df: DataFrame,
    edges_df: DataFrame,
    n_lines: int,
    iterations: int,
    alpha: float | str = 0.15,
    alpha_precision: str = "double",
    num_partitions: int | None = None,
    checkpoint_every: int | None = 5,
    hot_factor: int = DEFAULT_HOT_FACTOR,
    hot_floor: int = DEFAULT_HOT_FLOOR,
    trace: list | None = None,
    on_state: Callable[[int, DataFrame], None] | None = None,
    layout_sink: list | None = None,
    hot_broadcast_bytes: int = HOT_BROADCAST_BYTES,
    titles: DataFrame | None = None,
) -> RankResult:
    """Continue a ranking from nodes(id, outdeg, rank) and edges(src, dst, mult), such as a kept state's.

    Where ids are numbers, ``titles`` (id, title) has their titles.

    The graph and the start ranks are written to the checkpoint folder once, so
    a lost executor never forces the input to be read again.
    """
    spark = nodes_df.sparkSession
    checkpoint_dir(spark)
    size = id_bytes(nodes_df) * 2 + 8 * F.col("outdeg")  # links weigh by their number; their targets' lengths aren't read
    row = nodes_df.agg(F.count(F.lit(1)).alias("v"), F.sum("outdeg").alias("k"), F.sum(size.cast("long")).alias("b")).first()
    stats = GraphStats(int(row["v"]), int(row["k"] or 0), int(row["b"] or 0))
    p = _partitions(spark, num_partitions, stats)
    with job_conf(spark, job_settings(p)):
        nodes_df = nodes_df.select("id", "outdeg", "rank").repartition(p, "id")
        layout = lay_out(
            nodes_df, edges_df, n_lines, stats.n_links, p, hot_factor, hot_floor, reliable=True, hot_broadcast_bytes=hot_broadcast_bytes
        )
        layout.titles = titles
        if layout_sink is not None:
            layout_sink.append(layout)
        start = layout.nodes.join(nodes_df.select("id", "rank").hint(layout.join_hint), "id", "left").checkpoint(eager=True)
        consts = RankConstants.of(alpha, n_lines, alpha_precision)
        state = _run(layout, consts, iterations, checkpoint_every, trace, start=start, on_state=on_state)
    return RankResult(state, layout, n_lines)


def ranking_output(output_path: str, preset: str | Preset) -> str:
    """Where ``run_job`` writes the ranking: ``<output>/sort`` for the MR preset, ``<output>`` otherwise."""
    base = output_path.rstrip("/")
    return f"{base}/sort" if get_preset(preset).name == "mapreduce" else base


def _refuse_existing(spark: SparkSession, paths: list[str]) -> None:
    for path in paths:
        if path_exists(spark, path):
            raise FileExistsError(f"output path already exists: {path}")


def run_job(
    spark: SparkSession,
    input_path: str | list[str] | None,
    output_path: str,
    iterations: int,
    alpha: float | str = 0.15,
    preset: str | Preset = "mapreduce",
    num_partitions: int | None = None,
    checkpoint_every: int | None = 5,
    keep_state: bool = False,
    mode: str = "errorifexists",
    resume_from: str | None = None,
    extractor: G.Extractor | None = None,
    state_format: str = "parquet",
    dictionary: bool = False,
    **layout_options,
) -> RankResult:
    """Whole job: text in, ranking out (I6-I8), with the output layout of each preset.

    * ``mapreduce``: ``<output>/count`` (``Total Pages-<N>``) and ``<output>/sort``
      (``title<TAB>rank``); with ``keep_state`` also ``<output>/parse`` (the initial
      state) and, after every step, ``<output>/rank-<i>``, the first being ``rank-0``
      (I2).  In the ``parquet`` form these are tables of nodes(id, outdeg, rank), and
      ``<output>/edges`` has (src, dst, mult) once for all of them; in the ``text`` form each
      folder has the graph-state records, a line for each page (``sources.state.export_state``
      makes them from a kept state at any time).
    * ``rdd_jvm`` / ``rdd_py``: the ranking itself at ``<output>`` in the pair form.

    With mode ``errorifexists`` every output path is looked at before the first
    Spark job, so a run that could not write its result does no work.  The tables
    written for the run are deleted when it ends, also when it fails.

    ``resume_from`` names a kept folder of either form (``.../parse`` or ``.../rank-<i>``, with
    ``count`` beside it): the input is not read, ``iterations`` more steps follow, and
    their folders go on from its number.  With ``dictionary`` (see ``rank_pages``) the kept tables
    have numbers and ``<output>/titles`` has their titles, once; a job that goes on from
    them has numbers too.  ``extractor`` and ``layout_options``: see ``rank_pages``.
    """
    from surfrank.sources import state as ST
    from surfrank.sources.sinks import write_ranked
    from surfrank.sources.text import read_count, read_lines, write_count_value

    preset = get_preset(preset)
    base = output_path.rstrip("/")
    mr_layout = preset.name == "mapreduce"
    if keep_state and not mr_layout:
        raise ValueError("per-step state files belong to the mapreduce output layout")
    if resume_from is not None and not mr_layout:
        raise ValueError("only the mapreduce layout has state folders to resume from")
    if state_format not in ("parquet", "text"):
        raise ValueError(f"unknown state form {state_format!r}")
    first, own_count = 0, mr_layout
    if resume_from is not None:
        parent, folder = resume_from.rstrip("/").rsplit("/", 1)
        first = int(folder.removeprefix("rank-")) + 1 if folder.startswith("rank-") else 0
        own_count = parent != base  # a run that goes on in its own folder has its count already
    outputs = [ranking_output(base, preset)] + ([f"{base}/count"] if own_count else [])
    own_edges = keep_state and state_format == "parquet" and not (resume_from and parent == base and path_exists(spark, f"{base}/edges"))
    if resume_from is not None:
        dictionary = path_exists(spark, f"{parent}/titles")
    if dictionary and keep_state and state_format == "text":
        raise ValueError("records hold titles: keep numbered states as tables and export them")
    if own_edges and dictionary:
        outputs.append(f"{base}/titles")
    if keep_state:
        outputs += [f"{base}/rank-{first + i}" for i in range(iterations)] + ([] if resume_from else [f"{base}/parse"]) + ([f"{base}/edges"] if own_edges else [])
    if mode in ("error", "errorifexists"):
        _refuse_existing(spark, outputs)
    layout_box: list[RankLayout] = []

    def keep(i: int, state: DataFrame) -> None:
        # written while the state is cached, and the count before the steps, so a run that dies can be resumed
        if i == 0 and own_count:
            write_count_value(spark, layout_box[0].n_lines, f"{base}/count", mode)
        if i == 0 and own_edges:
            layout_box[0].edges().write.mode(mode).parquet(f"{base}/edges")
            if layout_box[0].titles is not None:
                layout_box[0].titles.write.mode(mode).parquet(f"{base}/titles")
        if keep_state and (i > 0 or resume_from is None):
            path = f"{base}/rank-{first + i - 1}" if i > 0 else f"{base}/parse"
            if state_format == "parquet":
                ST.write_nodes(state, path, mode)
            else:
                ST.write_state(ST.layout_records(state, layout_box[0]), path, mode)

    try:
        if resume_from is not None:
            n_lines = int(read_count(spark, f"{parent}/count").first()["n_lines"])
            again = dict(num_partitions=num_partitions, checkpoint_every=checkpoint_every, on_state=keep, layout_sink=layout_box, **layout_options)
            if path_exists(spark, f"{parent}/edges"):
                result = resume_from_tables(*ST.read_kept(spark, resume_from), n_lines, iterations, alpha, preset.alpha_precision, titles=ST.read_titles(spark, resume_from), **again)
            else:
                result = resume_from_records(ST.read_state(spark, resume_from), n_lines, iterations, alpha, preset.alpha_precision, **again)
        else:
            result = rank_pages(
                read_lines(spark, input_path), iterations, alpha, preset, num_partitions, checkpoint_every,
                on_state=keep, layout_sink=layout_box, extractor=extractor, dictionary=dictionary, **layout_options,
            )
        write_ranked(result.ranked(), ranking_output(base, preset), preset.output_format, mode)
    finally:
        for layout in layout_box:
            layout.release()  # the final state is its own checkpoint
    return result

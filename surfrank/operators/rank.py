"""One random-surfer step as joins and aggregates.

``rank'(v) = alpha/N + (1-alpha) * sum over links u->v of rank(u)/outdeg(u)``;
dangling vertices send nothing, vertices without in-links get exactly alpha/N.

Physical layout (see ``RankLayout``): the cached node table and every state
are hash-partitioned by ``id``, the regular ("cold") edges by ``src``, all with
the same partition count, so the edge/share join needs no exchange; the only
shuffle of a step is the partial-summed contributions by ``dst``, whose output
is again laid out like the node table, so the left join that applies the update
needs no exchange either.  Sources whose out-degree would make one join task hold a large share
of the edges ("hot" sources) are handled apart.  They are known by a table of
64-bit hashes, ``hot_keys``, bounded by construction (see ``surfrank.plans.layout``).
While their shares, titles included, are few bytes, their edges are spread by ``dst``
and meet a broadcast of the shares; beyond that their edges are spread by
(``src``, ``salt``) and meet the shares, one row for each salt, in a shuffle join.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def float32_of(text: str | float) -> np.float32:
    """Nearest float32 to a decimal literal, ties to even (as a JVM ``parseFloat``).

    Going through a double first (``np.float32(float(text))``) can round twice.
    """
    from decimal import Decimal

    dec = Decimal(repr(text) if isinstance(text, float) else str(text).strip())
    guess = np.float32(float(dec))
    best = None
    for c in (np.nextafter(guess, np.float32(-np.inf)), guess, np.nextafter(guess, np.float32(np.inf))):
        err = abs(Decimal(float(c)) - dec)
        even = (int(c.view(np.uint32)) & 1) == 0
        key = (err, not even)
        if best is None or key < best[0]:
            best = (key, c)
    return np.float32(best[1])


@dataclass(frozen=True)
class RankConstants:
    """Plan literals of the update: ``rank' = jump + keep * s``."""

    initial: float
    jump: float
    keep: float

    @staticmethod
    def of(alpha: float | str, n_lines: int, precision: str = "double") -> "RankConstants":
        """``alpha`` may be given as text, which keeps its exact decimal value for float32."""
        n = int(n_lines)
        initial = 1.0 / n if n else float("nan")
        if precision == "double":
            a = float(alpha)
            return RankConstants(initial, a / n if n else float("nan"), 1.0 - a)
        if precision == "float32":
            # float32 alpha: alpha/N is float/long -> float, 1-alpha is float; both
            # are then widened to double and combined with the double sum.
            a32 = float32_of(alpha)
            jump = float(a32 / np.float32(n)) if n else float("nan")
            keep = float(np.float32(1.0) - a32)
            return RankConstants(initial, jump, keep)
        raise ValueError(f"unknown alpha_precision {precision!r}")


def initial_rank(nodes_df: DataFrame, consts: RankConstants) -> DataFrame:
    """Every vertex starts at 1/N, N being the number of input lines."""
    return nodes_df.withColumn("rank", F.lit(consts.initial).cast("double"))


def shares(state: DataFrame) -> DataFrame:
    """rank/outdeg of every non-dangling vertex, keyed as ``src``."""
    return state.where(F.col("outdeg") > 0).select(
        F.col("id").alias("src"), (F.col("rank") / F.col("outdeg")).alias("share")
    )


def contributions(edges_df: DataFrame, share_df: DataFrame, with_src: bool = False, hint: str = "shuffle_hash") -> DataFrame:
    """One row per distinct link: (dst, c) with c = mult * rank(src)/outdeg(src).

    Hash join with the shares as build side: a task hashes its V/P shares and
    streams its E/P edges, so the edges (the largest table) are never sorted.
    Where V/P shares are too many to hash, the layout's hint is ``merge``, a join that can spill.
    """
    return _weighted(edges_df.join(share_df.hint(hint), "src"), with_src)


def _weighted(flows: DataFrame, with_src: bool = False) -> DataFrame:
    return flows.select(*(["src", "dst"] if with_src else ["dst"]), (F.col("mult") * F.col("share")).alias("c"))


def zero_mass(nodes_df: DataFrame) -> DataFrame:
    """(id, c = 0.0) for every vertex, so vertices without in-links keep a row."""
    return nodes_df.select("id", F.lit(0.0).alias("c"))


def contribution_sums_with_zero(contrib: DataFrame, nodes_df: DataFrame) -> DataFrame:
    """Bag union of link shares and zero rows, summed per vertex: (id, s)."""
    shares_in = contrib.select(F.col("dst").alias("id"), "c")
    return shares_in.unionByName(zero_mass(nodes_df)).groupBy("id").agg(F.sum("c").alias("s"))


def contribution_sums(contrib: DataFrame) -> DataFrame:
    """Sum of contributions per target: (id, s) (A5).  Partial sums run map-side."""
    return contrib.groupBy(F.col("dst").alias("id")).agg(F.sum("c").alias("s"))


def update(consts: RankConstants, s: Column) -> Column:
    """rank' = alpha/N + (1-alpha) * s, with s = 0 for vertices without in-links."""
    return F.lit(consts.jump) + F.lit(consts.keep) * F.coalesce(s, F.lit(0.0))


@dataclass
class RankLayout:
    """Loop-invariant tables of a ranking job, laid out for co-partitioned steps."""

    nodes: DataFrame  # id, outdeg, hot -- hash(id, P)
    cold_edges: DataFrame  # src, dst, mult -- hash(src, P)
    hot_edges: DataFrame | None  # src, dst, mult -- hash(dst, P), or with salt -- hash(src, salt, P); None when no hot source
    num_partitions: int
    n_lines: int
    n_vertices: int
    n_hot: int
    written: tuple[str, ...] = ()  # tables this layout wrote to the checkpoint folder
    tables: tuple[str, ...] = ()  # their entries in the catalog
    hot_keys: DataFrame | None = None  # src_hash, salts: 12 bytes for each of at most hot_factor * P sources
    salted: bool = False
    join_hint: str = "shuffle_hash"  # of joins between tables of this layout
    titles: DataFrame | None = None  # id, title, where ids are numbers

    def edges(self) -> DataFrame:
        """All edges (src, dst, mult), cold and hot."""
        if self.hot_edges is None:
            return self.cold_edges
        return self.cold_edges.unionByName(self.hot_edges.select("src", "dst", "mult"))

    def release(self, delete_written: bool = True) -> None:
        """Unpersist the tables and delete the copies this layout wrote (exact names and paths only)."""
        for df in (self.nodes, self.cold_edges, self.hot_edges):
            if df is not None:
                df.unpersist()
        if delete_written and self.written:
            spark = self.nodes.sparkSession
            for name in self.tables:
                spark.sql(f"DROP TABLE IF EXISTS {name}")
            jvm = spark.sparkContext._jvm
            hconf = spark.sparkContext._jsc.hadoopConfiguration()
            for path in self.written:
                jpath = jvm.org.apache.hadoop.fs.Path(path)
                jpath.getFileSystem(hconf).delete(jpath, True)


def source_hash(column: str = "src") -> Column:
    """The 64-bit hash by which hot sources are known."""
    return F.xxhash64(F.col(column))


def hot_flows(layout: RankLayout, per_source: DataFrame) -> DataFrame:
    """The hot sources' edges (src, dst, mult) joined with a per-source table keyed by ``src``."""
    own = per_source.join(F.broadcast(layout.hot_keys), source_hash() == F.col("src_hash")).drop("src_hash")
    if not layout.salted:
        return layout.hot_edges.join(F.broadcast(own.drop("salts")), "src")
    own = own.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).drop("salts")
    own = own.repartition(layout.num_partitions, "src", "salt")
    return layout.hot_edges.join(own.hint(layout.join_hint), ["src", "salt"]).drop("salt")


def join_sources(layout: RankLayout, per_source: DataFrame) -> DataFrame:
    """All edges (src, dst, mult) joined with a per-source table keyed by ``src``.

    Regular sources meet their edges in a join on the shared layout, hot sources
    as ``hot_flows`` says.  No source's edges are ever gathered into one task.
    """
    out = layout.cold_edges.join(per_source.hint(layout.join_hint), "src")
    return out if layout.hot_edges is None else out.unionByName(hot_flows(layout, per_source))


def rank_step(layout: RankLayout, state: DataFrame, consts: RankConstants) -> DataFrame:
    """state(id, outdeg, hot, rank) -> the same columns after one step (J2 as a left join).

    The update's left side is the loop-invariant node table, so the step reads
    its predecessor once, for the shares.  With hot sources it reads it once more
    for theirs, so ``state`` should be a leaf then (``plans.job.iterate``
    checkpoints every state).
    """
    share = shares(state)
    sent = contributions(layout.cold_edges, share, hint=layout.join_hint)
    if layout.hot_edges is not None and layout.salted:
        sent = sent.unionByName(_weighted(hot_flows(layout, share)))
    joined = layout.nodes.join(contribution_sums(sent).hint(layout.join_hint), "id", "left")
    total = F.coalesce(F.col("s"), F.lit(0.0))
    if layout.hot_edges is not None and not layout.salted:
        hot = contribution_sums(_weighted(hot_flows(layout, share))).withColumnRenamed("s", "s_hot")
        joined = joined.join(hot.hint(layout.join_hint), "id", "left")
        total = total + F.coalesce(F.col("s_hot"), F.lit(0.0))
    return joined.select("id", "outdeg", "hot", update(consts, total).alias("rank"))

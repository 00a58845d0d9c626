"""Numbers in place of titles: a job whose steps shuffle and cache longs only.

Every vertex gets a 64-bit number (U2, G1).  The table of titles and numbers comes out of the
node aggregate, a number being the partition's number and the row's place in it, and is
written once to the checkpoint folder, since the numbers can't be made again; it is bucketed by
title, so it meets the links without being shuffled.  Links are counted by title first and then get their
numbers by two joins, one for each end.  The ranks get their titles back once, after the last step.

It costs a second and a third shuffle of the links' titles while the graph is built, and saves a
shuffle of a title for each link target in every step, and the titles in the cached edges.  So it pays for
long titles or many steps.

Titles with more than T links on either side (T as in ``plans.layout``) would make one task of a
join hold their links.  There are at most ``2 * hot_factor * P`` of them, as the links of either side add up to all
links.  They are known by 64-bit hashes, which are broadcast (24 bytes each), and their
links meet them by (title, salt) with a salt for every T links.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surfrank.operators import graph as G
from surfrank.operators.rank import RankLayout, source_hash
from surfrank.plans.layout import hot_threshold, joined_by, write_bucketed
from surfrank.plans.presets import Preset
from surfrank.session import scratch_path


@dataclass
class Numbered:
    """The graph of a job in numbers."""

    titles: DataFrame  # id long, title, outdeg, indeg -- bucketed by title
    nodes: DataFrame  # id, outdeg -- hash(id, P)
    links: DataFrame  # src, dst, mult, counted
    written: list[str] = field(default_factory=list)
    tables: list[str] = field(default_factory=list)

    def attach(self, layout: RankLayout) -> RankLayout:
        """The layout of this graph, which from now on owns what was written here."""
        layout.titles = self.titles.select("id", "title")
        layout.written += tuple(self.written)
        layout.tables += tuple(self.tables)
        return layout


def degrees(pages: DataFrame, preset: Preset) -> DataFrame:
    """(title, outdeg, indeg) of every vertex: link occurrences from it and to it, in one aggregate."""
    rows = G.title_and_targets(pages, preset).select(F.col("id").alias("title"), F.coalesce("d", F.lit(0)).alias("o"), F.col("d").isNull().cast("int").alias("i"))
    return rows.groupBy("title").agg(F.sum("o").alias("outdeg"), F.sum("i").alias("indeg"))


def number_ends(rows: DataFrame, end: str, number: str, other: str, titles: DataFrame, hot: DataFrame | None, salts: str, hint: str) -> DataFrame:
    """``rows`` with the number of the title in column ``end`` in its place, as ``number``.

    The rows of a hot title are spread by a hash of ``other``; rows are distinct in (``end``, ``other``).
    """
    named = titles.select(F.col("title").alias(end), F.col("id").alias(number))
    if hot is None:
        return rows.join(named.hint(hint), end).drop(end)
    keys = F.broadcast(hot.select("src_hash", F.col(salts).alias("salts")))
    is_key = source_hash(end) == F.col("src_hash")
    cold = rows.join(keys, is_key, "left_anti").join(named.hint(hint), end).drop(end)
    spread = rows.join(keys, is_key).withColumn("salt", F.pmod(F.xxhash64(other), F.col("salts")).cast("int")).drop("src_hash", "salts")
    copies = named.join(keys, is_key).withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).drop("src_hash", "salts")
    return cold.unionByName(spread.join(copies.hint(hint), [end, "salt"]).drop(end, "salt"))


def number_graph(pages: DataFrame, preset: Preset, n_links: int, p: int, hot_factor: int, hot_floor: int) -> Numbered:
    """The graph of ``pages`` in numbers.  It runs in the settings of ``plans.job.job_settings``."""
    spark = pages.sparkSession
    paths: list[str] = []
    names: list[str] = []
    # partition number and place: unique without a count, and one pass
    tagged = degrees(pages, preset).select(F.monotonically_increasing_id().alias("id"), "title", "outdeg", "indeg")
    titles = write_bucketed(tagged, p, ("title",), paths, names)
    threshold = hot_threshold(n_links, p, hot_factor, hot_floor)
    is_hot = F.greatest("outdeg", "indeg") > F.lit(threshold)
    row = titles.agg(F.count(F.lit(1)).alias("v"), F.count(F.when(is_hot, 1)).alias("h")).first()
    hint, hot = joined_by(int(row["v"]), p), None
    if row["h"]:
        count = lambda c: F.greatest(F.lit(1), F.ceil(F.max(c) / threshold)).cast("int").alias(f"{c}_salts")
        keys = titles.where(is_hot).groupBy(source_hash("title").alias("src_hash")).agg(count("outdeg"), count("indeg"))
        hot = keys.coalesce(min(p, 4)).checkpoint(eager=True)  # at most 2 * hot_factor * P rows

    def kept(df: DataFrame) -> DataFrame:
        paths.append(scratch_path(spark, "links"))
        df.write.parquet(paths[-1])
        return spark.read.schema(df.schema).parquet(paths[-1])

    links = G.edges(pages, preset)
    half = number_ends(links, "src", "s", "dst", titles, hot, "outdeg_salts", hint)
    if hot is not None:
        half = kept(half)  # read twice
    whole = number_ends(half, "dst", "d", "s", titles, hot, "indeg_salts", hint)
    whole = kept(whole.select(F.col("s").alias("src"), F.col("d").alias("dst"), "mult"))
    return Numbered(titles, titles.select("id", "outdeg").repartition(p, "id"), whole, paths, names)


def with_titles(state: DataFrame, layout: RankLayout) -> DataFrame:
    """A numbered state with titles as ids again: (id, outdeg, hot, rank)."""
    named = layout.titles.join(state.hint(layout.join_hint), "id")
    return named.select(F.col("title").alias("id"), "outdeg", "hot", "rank")

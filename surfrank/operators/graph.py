"""From parsed pages to a link graph: vertices, weighted edges, out-degrees.

The graph is kept normalised.  ``edges(src, dst, mult)`` holds one row per
distinct link with its multiplicity (repeated links count repeatedly), and
``nodes(id, outdeg)`` holds every vertex: page titles *and* link targets that
have no page of their own.  No per-title list is ever collected, so a title
with a huge number of links (or repeated across many lines) never becomes one
giant row: every aggregate here is a partial/final hash aggregate.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surfrank.functions.extract import parse_line
from surfrank.plans.presets import Preset


#: Line column -> (title, null when unparsable; array of link targets).
Extractor = Callable[[Column], tuple[Column, Column]]


def parse_pages(lines: DataFrame, preset: Preset, column: str = "value", extractor: Extractor | None = None) -> DataFrame:
    """One row per input line: ``title`` (null when unparsable) and ``outlinks``."""
    title, links = parse_line(F.col(column), preset) if extractor is None else extractor(F.col(column))
    return lines.select(title.alias("title"), links.alias("outlinks"))


def parsed_ok(parsed: DataFrame) -> DataFrame:
    """Rows whose title parsed (F1).  Positional presets never yield null titles."""
    return parsed.where(F.col("title").isNotNull())


def kept_links(preset: Preset, links: Column | str = "outlinks") -> Column:
    """Links that become edges: blank targets are markers under the MR rule (F2)."""
    links = F.col(links) if isinstance(links, str) else links
    if preset.blank_links == "marker":
        return F.filter(links, lambda x: x != F.lit(""))
    if preset.blank_links == "keep":
        return links
    raise ValueError(f"unknown blank_links {preset.blank_links!r}")


def link_occurrences(pages: DataFrame, preset: Preset) -> DataFrame:
    """One row per kept link occurrence: (src, dst).  Pages without links emit nothing."""
    kept_links(preset)  # refuses an unknown rule
    rows = pages.select(F.col("title").alias("src"), F.explode("outlinks").alias("dst"))
    return rows.where(F.col("dst") != F.lit("")) if preset.blank_links == "marker" else rows


def edges(pages: DataFrame, preset: Preset) -> DataFrame:
    """Distinct links with multiplicity: (src, dst, mult) (A7).  Map-side partial count."""
    return link_occurrences(pages, preset).groupBy("src", "dst").agg(F.count(F.lit(1)).alias("mult"))


def vertices(pages: DataFrame) -> DataFrame:
    """Vertex closure: page titles and every link target, blank ones included."""
    ids = F.array_union(F.array(F.col("title")), F.col("outlinks"))
    return pages.select(F.explode(ids).alias("id")).distinct()


def title_and_targets(pages: DataFrame, preset: Preset) -> DataFrame:
    """(id, d): each page's title with its number of kept links, and each of its link targets with null."""
    ids = F.concat(F.array("title"), "outlinks")
    return pages.select(F.inline(F.arrays_zip(ids, F.array(F.size(kept_links(preset)).cast("long")))).alias("id", "d"))


def nodes(pages: DataFrame, preset: Preset) -> DataFrame:
    """Every vertex with its out-degree (number of kept link occurrences), in one aggregate.

    Each page row contributes (title, #kept links) and (target, 0) per link, so the
    vertex closure and the out-degree come out of a single partial/final sum.
    """
    rows = title_and_targets(pages, preset).select("id", F.coalesce("d", F.lit(0)).alias("d"))
    return rows.groupBy("id").agg(F.sum("d").alias("outdeg"))


def dangling_nodes(nodes_df: DataFrame) -> DataFrame:
    """Vertices with no outgoing link (F5): their mass is dropped each step."""
    return nodes_df.where(F.col("outdeg") == 0).select("id")


def adjacency_entries(pages: DataFrame) -> DataFrame:
    """Merged link multiset per title, blank links included: (title, link, mult) (A2).

    This is the normalised form of "concatenate the link lists of equal titles":
    a multiset is exactly the (link, count) pairs, and it never builds a list.
    """
    occ = pages.select("title", F.explode("outlinks").alias("link"))
    return occ.groupBy("title", "link").agg(F.count(F.lit(1)).alias("mult"))

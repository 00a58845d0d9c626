"""The tables of a ranking job: how the graph is partitioned, written and cached.

* The node table comes out of its one aggregate hash-partitioned by ``id``.
* Hot sources are found on it: a source is hot when its out-degree exceeds
  ``T = max(hot_floor, ceil(links / (hot_factor * P)))``.  Their out-degrees add up to
  at most ``links``, so there are at most ``hot_factor * P`` of them.  From then on they are
  known by 64-bit hashes of their titles (``hot_keys``), so what is broadcast to split the
  edges is at most 12 bytes * hot_factor * P, whatever the length of the titles.  A regular source
  whose hash is that of a hot one is hot as well, in both tables.
* Regular links are shuffled once, by ``src``, and counted there: no source has more
  than T of them.  Hot links are counted map-side first and then spread, by ``dst`` if
  the hot sources' shares are up to ``HOT_BROADCAST_BYTES``, measured with their titles, else by
  (``src``, ``salt``) with ceil(outdeg / T) salts for a source.
* A reliable copy is a bucketed table: it is written as it is partitioned, a file for
  each bucket, and read back with the same partitioning, so nothing is shuffled again.  A
  lost cached block is read again from its bucket.  Buckets need an entry in the
  session's catalog, an external table in the current database that ``RankLayout.release`` drops.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from surfrank.operators.rank import RankLayout, source_hash
from surfrank.session import scratch_path

DEFAULT_HOT_FACTOR = 4
DEFAULT_HOT_FLOOR = 1_000_000
#: Shares of hot sources, titles included, that are broadcast.
HOT_BROADCAST_BYTES = 64 << 20
#: Vertices of a partition up to which a task hashes them; beyond, joins are by sort and merge, which can spill.
HASHED_VERTICES = 4_000_000


def id_bytes(nodes: DataFrame) -> Column:
    """Bytes of a vertex's id, a title or a number."""
    return F.octet_length("id") if nodes.schema["id"].dataType == StringType() else F.lit(8)


def hot_threshold(n_links: int, num_partitions: int, hot_factor: int, hot_floor: int) -> int:
    return max(int(hot_floor), math.ceil(n_links / max(1, hot_factor * num_partitions)))


def joined_by(n_vertices: int, p: int) -> str:
    """The hint of joins with tables that have a row for each vertex."""
    return "shuffle_hash" if n_vertices <= HASHED_VERTICES * p else "merge"


def write_bucketed(df: DataFrame, p: int, keys: tuple[str, ...], paths: list[str], names: list[str]) -> DataFrame:
    """``df``, which is hash-partitioned by ``keys`` into P partitions, as a bucketed table; its path and catalog entry go to the lists."""
    path = scratch_path(df.sparkSession, "graph")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    paths.append(path)
    names.append(name)
    df.write.format("parquet").bucketBy(p, *keys).option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


class _Tables:
    """Cached tables, with or without a written copy."""

    def __init__(self, p: int, storage: StorageLevel, reliable: bool):
        self.p, self.storage, self.reliable = p, storage, reliable
        self.paths: list[str] = []
        self.names: list[str] = []

    def keep(self, df: DataFrame, *keys: str) -> DataFrame:
        """``df``, which is hash-partitioned by ``keys`` into P partitions, marked cached."""
        if self.reliable:
            df = write_bucketed(df, self.p, keys, self.paths, self.names)
        return df.persist(self.storage)


def lay_out(
    nodes_df: DataFrame,
    links: DataFrame,
    n_lines: int,
    n_links: int,
    num_partitions: int,
    hot_factor: int = DEFAULT_HOT_FACTOR,
    hot_floor: int = DEFAULT_HOT_FLOOR,
    storage: StorageLevel = StorageLevel.MEMORY_AND_DISK,
    reliable: bool = False,
    hot_broadcast_bytes: int = HOT_BROADCAST_BYTES,
    each: Callable[[DataFrame], DataFrame] | None = None,
    count_parts: int = 1,
) -> RankLayout:
    """Layout of ``nodes_df`` (id, outdeg), hash-partitioned by ``id`` into P partitions, and ``links``.

    ``links`` has a row for each link occurrence (src, dst), or is counted already (src, dst, mult).  With
    ``each`` it has a row for each page (src, ...) and ``each`` makes the links of such rows, so hot and
    regular sources are told apart once for a page, not for each of its links.  They are counted in ``count_parts``
    partitions if these are more than P, so what a task counts doesn't grow where P is held low.
    It runs in the settings of ``plans.job.job_settings``.  The caller may release
    its input right after: without a written copy, everything is materialised here.
    """
    p = num_partitions
    tables = _Tables(p, storage, reliable)
    threshold = hot_threshold(n_links, p, hot_factor, hot_floor)
    nodes = tables.keep(nodes_df.select("id", "outdeg"), "id")
    is_hot = F.col("outdeg") > F.lit(threshold)
    size = F.when(is_hot, id_bytes(nodes) + 24).cast("long")
    row = nodes.agg(F.count(F.lit(1)).alias("v"), F.count(F.when(is_hot, 1)).alias("h"), F.sum(size).alias("b")).first()
    n_vertices, n_hot, hot_bytes = int(row["v"]), int(row["h"]), int(row["b"] or 0)
    if n_hot > hot_factor * p:  # the hot out-degrees add up to at most n_links, and each exceeds n_links / (hot_factor * P)
        raise AssertionError(f"hot-source bound violated: {n_hot} > {hot_factor * p}")

    counted = each is None and "mult" in links.columns
    if each is None:
        links, each = links.select("src", "dst", *(["mult"] if counted else [])), lambda rows: rows
    total = F.sum("mult") if counted else F.count(F.lit(1))
    hot_keys, hot, salted = None, None, hot_bytes > hot_broadcast_bytes
    cold = links
    if n_hot == 0:
        flagged = nodes.withColumn("hot", F.lit(False))
    else:
        keys = nodes.where(is_hot).groupBy(source_hash("id").alias("src_hash")).agg(F.ceil(F.max("outdeg") / threshold).cast("int").alias("salts"))
        hot_keys = keys.coalesce(min(p, 4)).checkpoint(eager=True)  # at most hot_factor * P rows of 12 bytes
        flagged = nodes.join(F.broadcast(hot_keys), source_hash("id") == F.col("src_hash"), "left").select("id", "outdeg", F.col("src_hash").isNotNull().alias("hot"))
        flagged = flagged.persist(storage)
        flagged.count()
        nodes.unpersist()
        is_key = source_hash() == F.col("src_hash")
        cold = links.join(F.broadcast(hot_keys), is_key, "left_anti")
        hot = each(links.join(F.broadcast(hot_keys), is_key, "left_semi")).groupBy("src", "dst").agg(total.alias("mult"))
        if salted:
            salt = F.pmod(F.xxhash64("dst"), F.col("salts")).cast("int").alias("salt")
            hot = hot.join(F.broadcast(hot_keys), is_key).select("src", "dst", "mult", salt)
            hot = tables.keep(hot.repartition(p, "src", "salt"), "src", "salt")
        else:
            hot = tables.keep(hot.select("src", "dst", "mult").repartition(p, "dst"), "dst")
    parts = max(p, count_parts)
    cold = each(cold).repartition(p if counted else parts, "src")
    if not counted:
        cold = cold.groupBy("src", "dst").agg(total.alias("mult"))  # in place: equal sources are together
        if parts > p:
            cold = cold.repartition(p, "src")
    cold = tables.keep(cold, "src")
    if not reliable:
        filled = cold.select(F.lit(1)) if hot is None else cold.select(F.lit(1)).unionByName(hot.select(F.lit(1)))
        filled.count()
    hint = joined_by(n_vertices, p)
    return RankLayout(flagged, cold, hot, p, n_lines, n_vertices, n_hot, tuple(tables.paths), tuple(tables.names), hot_keys, salted, hint)

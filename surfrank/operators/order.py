"""Global order of the ranking and a distributed position column (O1, O2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from surfrank.session import checkpoint_dir

_LOCAL_INDEX_MASK = (1 << 33) - 1  # monotonically_increasing_id keeps the row index in the low 33 bits


def order_ranked(ranks: DataFrame, rank: str = "rank", title: str = "title") -> DataFrame:
    """Highest rank first, equal ranks by title ascending (range-partitioned sort)."""
    return ranks.orderBy(F.col(rank).desc(), F.col(title).asc())


def distinct_ranked(ranks: DataFrame, rank: str = "rank", title: str = "title") -> DataFrame:
    """One row for each (rank, title) key, for raw or repeated state (A8): a partial and a final aggregate before the sort."""
    return ranks.groupBy(title, rank).agg(F.count(F.lit(1)).alias("n")).select(title, rank)


def with_position(ordered: DataFrame, name: str = "pos") -> DataFrame:
    """Add a 1-based global position to a globally sorted DataFrame.

    No single-partition window: every row gets (partition id, index within the
    partition); the per-partition row counts (one row per partition, so bounded
    by the partition count) are turned into offsets and broadcast back.  The
    tagged rows are written once with a reliable checkpoint, so both passes read
    the same rows even if an executor is lost (the tags are not recomputable).
    """
    checkpoint_dir(ordered.sparkSession)
    tagged = ordered.select(
        "*",
        F.spark_partition_id().alias("_pid"),
        (F.monotonically_increasing_id().bitwiseAND(F.lit(_LOCAL_INDEX_MASK))).alias("_idx"),
    ).checkpoint(eager=True)
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    upto = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(upto), F.lit(0)).alias("_off"))
    cols = [c for c in ordered.columns]
    return (
        tagged.join(F.broadcast(offsets), "_pid")
        .select(*cols, (F.col("_off") + F.col("_idx") + 1).alias(name))
    )

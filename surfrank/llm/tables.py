"""Intermediate tables in the folder that the cluster shares."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surfrank.session import checkpoint_dir, scratch_path

#: Bits of the filter in ``likely``; it is broadcast as at most one row of two longs for every 64.
FILTER_BITS = 1 << 24
#: Largest table that ``broadcast_if_small`` broadcasts, in bytes.
BROADCAST_BYTES = 16 << 20


def settled(df: DataFrame) -> DataFrame:
    """``df`` kept by a reliable checkpoint: its lineage ends in files that all executors share."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str, paths: list[str] | None = None) -> DataFrame:
    """``df`` as a Parquet table in the shared scratch folder (compact, pruned by column when reread).

    ``paths`` gets its path, for ``deleted`` when the table is done with.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    if paths is not None:
        paths.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def deleted(spark: SparkSession, paths: list[str]) -> None:
    """Deletes tables that ``written`` made, by their exact paths, and empties the list."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)
    paths.clear()


def _filter(keys: DataFrame, key: str) -> tuple[DataFrame, F.Column]:
    """A bit for the hash of each key, to be broadcast, and the condition that a row's key has its bit."""
    slot = f"pmod(xxhash64({key}), {FILTER_BITS}L)"
    word, bit = F.expr(f"shiftright({slot}, 6)"), F.expr(f"shiftleft(1L, CAST({slot} & 63L AS INT))")
    bits = keys.select(word.alias("filter_word"), bit.alias("bit")).groupBy("filter_word").agg(F.bit_or("bit").alias("filter_bits"))
    return F.broadcast(bits), (word == F.col("filter_word")) & (bit.bitwiseAND(F.col("filter_bits")) != 0)


def likely(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The rows whose ``key`` may be among ``keys``: each that is, and few others while the keys are far fewer than FILTER_BITS.

    A filter before a shuffle join, which still decides.  The broadcast has one
    bit for the hash of a key, so its size is bounded whatever the number of
    keys; with more keys than bits it just lets most rows pass.
    """
    return rows.join(*_filter(keys, key), "left_semi")


def without(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The rows whose ``key`` isn't among ``keys`` (a written or settled table with this column); null keys stay.

    Few keys are broadcast.  Otherwise only the rows whose key may be among them
    are shuffled; the others, most of them, pass by the filter alone.
    """
    small = broadcast_if_small(keys)
    if small is not keys:
        return rows.join(small, key, "left_anti")
    return rows.join(*_filter(keys, key), "left_anti").unionByName(likely(rows, keys, key).join(keys.hint("merge"), key, "left_anti"))


def broadcast_if_small(df: DataFrame, limit: int | None = None) -> DataFrame:
    """``df`` with a broadcast hint if its rows, measured, take ``limit`` bytes or less (BROADCAST_BYTES); else ``df`` itself, for a shuffle join.

    ``df`` should be a written or settled table, as it is read here once to be measured.
    """
    width = 16 + 8 * len(df.columns)
    lengths = [F.coalesce(F.octet_length(f"`{c}`"), F.lit(0)) for c, kind in df.dtypes if kind in ("string", "binary")]
    lengths += [F.coalesce(F.size(f"`{c}`"), F.lit(0)) * 8 for c, kind in df.dtypes if kind.startswith("array")]
    size = df.agg(F.sum(sum(lengths, F.lit(width)).cast("long"))).first()[0] or 0
    return F.broadcast(df) if size <= (BROADCAST_BYTES if limit is None else limit) else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")

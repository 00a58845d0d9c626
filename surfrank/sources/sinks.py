"""Ranked-output sinks and their readers (K3, K4, K5, O3).

The ranking is written from a range-partitioned sort: part files are globally
ordered by name, and each file is ordered inside, so reading them in name order
gives the single ordered file a one-reducer job would write, without funnelling
the whole ranking through one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surfrank.functions import render as R

FORMATS = ("tsv", "tuple_jvm", "tuple_py")


def render_ranked(ranked: DataFrame, fmt: str = "tsv") -> DataFrame:
    """(title, rank) rows -> one text column ``value`` in the chosen form; order kept."""
    if fmt == "tsv":
        line = R.tsv_line("title", "rank")
    elif fmt == "tuple_jvm":
        line = R.tuple_jvm_line("title", "rank")
    elif fmt == "tuple_py":
        line = R.tuple_py_line(F.col("title"), F.col("rank"))
    else:
        raise ValueError(f"unknown format {fmt!r}; choose one of {FORMATS}")
    return ranked.select(line.alias("value"))


def write_ranked(ranked: DataFrame, path: str, fmt: str = "tsv", mode: str = "errorifexists") -> None:
    """Write an ordered ranking as text (K3-K5).  Existing paths are refused by default."""
    render_ranked(ranked, fmt).write.mode(mode).text(path)


def write_ranked_parquet(ranked: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Columnar form of the ranking, (title, rank), range-ordered part files."""
    ranked.select("title", "rank").write.mode(mode).parquet(path)


def parse_ranked(lines: DataFrame, fmt: str = "tsv", column: str = "value") -> DataFrame:
    """Text lines of a ranking -> (title, rank)."""
    if fmt == "tsv":
        return lines.select(*R.parse_tsv(column))
    if fmt == "tuple_jvm":
        return lines.select(*R.parse_tuple_jvm(column))
    if fmt == "tuple_py":
        return lines.select(R.parse_tuple_py(F.col(column)).alias("p")).select("p.title", "p.rank")
    raise ValueError(f"unknown format {fmt!r}; choose one of {FORMATS}")


def read_ranked(spark: SparkSession, path: str, fmt: str = "tsv") -> DataFrame:
    return parse_ranked(spark.read.text(path), fmt)

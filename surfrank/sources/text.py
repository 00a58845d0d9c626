"""Line sources and the page-count sink.

Sinks use Spark's default save mode, ``errorifexists``: an existing output
path is refused, as Hadoop output formats refuse it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values: page-count record format --------------------------------
COUNT_KEY = "Total Pages"
COUNT_SEPARATOR = "-"
# ---------------------------------------------------------------------------


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per text line of files, folders or compressed files.

    Lines end at ``\\n``, ``\\r`` or ``\\r\\n``; the column is ``value``.
    """
    return spark.read.text(path)


def write_lines(lines: DataFrame, path: str, column: str = "value", mode: str = "errorifexists") -> None:
    lines.select(F.col(column).alias("value")).write.mode(mode).text(path)


def page_count(lines: DataFrame) -> DataFrame:
    """One row: ``n_lines``, every line counted, blank or unparsable (A1, S3)."""
    return lines.agg(F.count(F.lit(1)).alias("n_lines"))


def count_line(lines: DataFrame) -> DataFrame:
    """One row: ``Total Pages-<N>`` (K1)."""
    n = page_count(lines)
    return n.select(F.concat(F.lit(COUNT_KEY + COUNT_SEPARATOR), F.col("n_lines").cast("string")).alias("value"))


def write_count(lines: DataFrame, path: str, mode: str = "errorifexists") -> None:
    count_line(lines).write.mode(mode).text(path)


def write_count_value(spark: SparkSession, n_lines: int, path: str, mode: str = "errorifexists") -> None:
    """Write ``Total Pages-<N>`` for an N already computed by the job (no second scan of the input)."""
    # one record, built JVM-side in a one-partition range
    row = spark.range(0, 1, 1, 1).select(F.lit(f"{COUNT_KEY}{COUNT_SEPARATOR}{int(n_lines)}").alias("value"))
    row.write.mode(mode).text(path)


def parse_count(c: str = "value") -> F.Column:
    """``Total Pages-<N>`` -> N; any other record fails the job (S3)."""
    key = F.substring_index(c, COUNT_SEPARATOR, 1)
    value = F.substring_index(c, COUNT_SEPARATOR, -1)
    return F.when(key == COUNT_KEY, value.cast("long")).otherwise(
        F.raise_error(F.concat(F.lit("not a page-count record: "), F.col(c)))
    )


def read_count(spark: SparkSession, path: str) -> DataFrame:
    """Parse a ``Total Pages-<N>`` file back to one row ``n_lines`` (S3)."""
    return spark.read.text(path).select(parse_count("value").alias("n_lines"))

"""Text renderings of (title, rank) pairs and their parse-back (K3-K5).

* TSV and the JVM tuple form are built-in expressions: Spark renders a double
  the way ``Double.toString`` does (``1.0E-5``).
* The Python tuple form is exactly ``repr((title, rank))`` (quote choice,
  escapes, shortest float repr).  Reproducing Python's repr rules with SQL
  expressions would be fragile, so this one sink uses a small Arrow-batched
  pandas UDF; it runs once, on the output only.
"""

from __future__ import annotations

import ast

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType


def java_double(c: Column | str) -> Column:
    """Double rendered as Java's ``Double.toString``."""
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("double").cast("string")


def tsv_line(title: Column | str, rank: Column | str) -> Column:
    """``title<TAB>rank`` (MR output)."""
    title = F.col(title) if isinstance(title, str) else title
    return F.concat(title, F.lit("\t"), java_double(rank))


def tuple_jvm_line(title: Column | str, rank: Column | str) -> Column:
    """``(title,rank)``, the string form of a JVM pair."""
    title = F.col(title) if isinstance(title, str) else title
    return F.concat(F.lit("("), title, F.lit(","), java_double(rank), F.lit(")"))


@F.pandas_udf(StringType())
def tuple_py_line(title: pd.Series, rank: pd.Series) -> pd.Series:
    """``repr((title, rank))``, the string form of a Python pair."""
    return pd.Series([repr((t, float(r))) for t, r in zip(title, rank)], dtype=object)


def parse_tsv(line: Column | str) -> tuple[Column, Column]:
    """Split at the last TAB: (title, rank)."""
    line = F.col(line) if isinstance(line, str) else line
    m = r"^(.*)\t([^\t]*)$"
    return (
        F.regexp_extract(line, m, 1).alias("title"),
        F.regexp_extract(line, m, 2).cast("double").alias("rank"),
    )


def parse_tuple_jvm(line: Column | str) -> tuple[Column, Column]:
    """``(title,rank)`` -> (title, rank); the title may itself contain commas."""
    line = F.col(line) if isinstance(line, str) else line
    m = r"^\((.*),([^,]*)\)$"
    return (
        F.regexp_extract(line, m, 1).alias("title"),
        F.regexp_extract(line, m, 2).cast("double").alias("rank"),
    )


_PAIR = StructType([StructField("title", StringType()), StructField("rank", DoubleType())])


@F.pandas_udf(_PAIR)
def parse_tuple_py(line: pd.Series) -> pd.DataFrame:
    """Inverse of ``tuple_py_line`` (a Python literal pair)."""
    pairs = [ast.literal_eval(s) for s in line]
    return pd.DataFrame({"title": [p[0] for p in pairs], "rank": [float(p[1]) for p in pairs]})

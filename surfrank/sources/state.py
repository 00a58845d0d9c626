"""Graph-state records: ``title<TAB>{"pageRank":..,"adjacencyList":[..],"isNode":..}``.

This is the interchange form of a ranking in progress (K2, S2, P13, P14, A3).
There is exactly one record for each page: its rank and its out-links with
repeats.  A record is a line of text by definition of the form, so a page's links
have to meet in one row here.  Jobs keep their states as tables of nodes
and edges instead, go on from these, and never make such a row; the lines are an export.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, StringType, StructField, StructType

from surfrank.session import path_exists

# --- fixed values: field names of the graph-state record ------------------
NODE_SCHEMA = StructType(
    [
        StructField("pageRank", DoubleType()),
        StructField("adjacencyList", ArrayType(StringType())),
        StructField("isNode", BooleanType()),
    ]
)
# ---------------------------------------------------------------------------


def state_records(state: DataFrame, flows: DataFrame) -> DataFrame:
    """State (id, outdeg, rank) and its edges with their source's rank (src, dst, mult, rank) -> (title, pageRank, adjacencyList, isNode).

    The rank travels with the edges, so the lists need no second join; vertices
    without links become records of their own.
    """
    linked = (
        flows.select("src", "rank", F.array_repeat("dst", F.col("mult").cast("int")).alias("run"))
        .groupBy("src")
        .agg(F.first("rank").alias("pageRank"), F.flatten(F.collect_list("run")).alias("adjacencyList"))
        .select(F.col("src").alias("title"), "pageRank", "adjacencyList", F.lit(True).alias("isNode"))
    )
    dangling = state.where(F.col("outdeg") == 0).select(
        F.col("id").alias("title"),
        F.col("rank").alias("pageRank"),
        F.array().cast("array<string>").alias("adjacencyList"),
        F.lit(True).alias("isNode"),
    )
    return linked.unionByName(dangling)


def layout_records(state: DataFrame, layout) -> DataFrame:
    """Graph-state records of a ranking state on its layout (cold and hot edges)."""
    from surfrank.operators.rank import join_sources

    return state_records(state, join_sources(layout, state.select(F.col("id").alias("src"), "rank")))


# ---------------------------------------------------------------- kept state: a pair of tables
def write_nodes(state: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """The part of a kept state that changes with a step: nodes(id, outdeg, rank)."""
    state.select("id", "outdeg", "rank").write.mode(mode).parquet(path)


def read_kept(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """nodes(id, outdeg, rank) of a kept folder and edges(src, dst, mult) from ``edges`` beside it."""
    parent = folder.rstrip("/").rsplit("/", 1)[0]
    kind = "string" if read_titles(spark, folder) is None else "long"
    nodes = spark.read.schema(f"id {kind}, outdeg long, rank double").parquet(folder)
    return nodes, spark.read.schema(f"src {kind}, dst {kind}, mult long").parquet(f"{parent}/edges")


def read_titles(spark: SparkSession, folder: str) -> DataFrame | None:
    """titles(id, title) beside a kept folder whose ids are numbers, else None."""
    path = folder.rstrip("/").rsplit("/", 1)[0] + "/titles"
    return spark.read.schema("id long, title string").parquet(path) if path_exists(spark, path) else None


def read_titled(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """``read_kept`` with titles as ids, whichever ids were kept."""
    nodes, edges = read_kept(spark, folder)
    titles = read_titles(spark, folder)
    if titles is None:
        return nodes, edges
    for end in ("src", "dst"):  # a target with very many links is split by adaptive execution
        edges = edges.join(titles.select(F.col("id").alias(end), F.col("title").alias(f"{end}_title")), end)
    return nodes.join(titles, "id").select(F.col("title").alias("id"), "outdeg", "rank"), edges.select(F.col("src_title").alias("src"), F.col("dst_title").alias("dst"), "mult")


def export_state(spark: SparkSession, folder: str, path: str, mode: str = "errorifexists") -> None:
    """The graph-state records of a kept folder, as lines (K2)."""
    nodes, edges = read_titled(spark, folder)
    write_state(state_records(nodes, edges.join(nodes.select(F.col("id").alias("src"), "rank"), "src")), path, mode)


def record_lines(records: DataFrame) -> DataFrame:
    """Records -> text lines ``title<TAB>json`` (K2)."""
    body = F.to_json(F.struct("pageRank", "adjacencyList", "isNode"))
    return records.select(F.concat(F.col("title"), F.lit("\t"), body).alias("value"))


def write_state(records: DataFrame, path: str, mode: str = "errorifexists") -> None:
    record_lines(records).write.mode(mode).text(path)


def parse_record_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Text lines -> records.  Key is the text before the first TAB, JSON the rest."""
    v = F.col(column)
    tab = F.instr(v, "\t")
    key = F.when(tab > 0, F.expr(f"substr(`{column}`, 1, instr(`{column}`, '\\t') - 1)")).otherwise(v)
    payload = F.when(tab > 0, F.expr(f"substr(`{column}`, instr(`{column}`, '\\t') + 1)")).otherwise(F.lit(""))
    node = F.from_json(payload, NODE_SCHEMA)
    return lines.select(key.alias("title"), node.alias("n")).select(
        "title", "n.pageRank", "n.adjacencyList", "n.isNode"
    )


def read_state(spark: SparkSession, path: str) -> DataFrame:
    return parse_record_lines(spark.read.text(path))


def ranks_from_records(records: DataFrame) -> DataFrame:
    """(title, rank) of every record; parts of one page carry the same rank."""
    return records.groupBy("title").agg(F.max("pageRank").alias("rank"))


def graph_from_records(records: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Records -> (nodes(id, outdeg), edges(src, dst, mult), ranks(id, rank)).

    Vertices are the titles plus every listed target, as a reducer would see
    keys that only receive messages.
    """
    occ = records.select(F.col("title").alias("src"), F.explode("adjacencyList").alias("dst"))
    edges_df = occ.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("mult"))
    own = F.array(F.struct(F.col("title").alias("id"), F.size("adjacencyList").cast("long").alias("d")))
    targets = F.transform("adjacencyList", lambda x: F.struct(x.alias("id"), F.lit(0).cast("long").alias("d")))
    nodes_df = (
        records.select(F.explode(F.concat(own, targets)).alias("r"))
        .select("r.id", "r.d")
        .groupBy("id")
        .agg(F.sum("d").alias("outdeg"))
    )
    ranks = ranks_from_records(records).withColumnRenamed("title", "id")
    return nodes_df, edges_df, ranks

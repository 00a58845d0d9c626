"""Exact top-k inner products by block-at-a-time pruning.

Vectors are put in ranges of vec_id and packed into blocks of ``block_rows``
vectors: a forward index (the block's vectors by row) and, for each component
(the terms of a vector), its largest and least value.  For a query, a block's
bound is the sum over the components of the larger product of the query's value with these.
Blocks are taken in order of bound and scored through their forward index
until the next bound falls below the query's k-th score; ties are still scored.

To start with a useful k-th score, each query is first scored against a pilot, a bounded sample of
``pilot_rows`` vectors chosen by a hash of the id: its k-th score there is a lower limit of the final one.
Queries then meet the bounds of groups of blocks only, and go on just to the groups whose bound reaches
that limit; groups that no query reaches are left where they are.
Queries meet the blocks in cells of (part of the queries, group of blocks),
which are the units of the shuffle, so no task holds all queries or all blocks.  Cells grow
with the input up to LARGEST_RANGE rows and LARGEST_PART queries; beyond, where bounds
prune nothing, the shuffle grows with rows times parts and queries times groups.

Each component x of a vector counts as floor(64 * x).  Vectors that are null or
hold a null or non-finite component take no part, as queries neither; rows with a null
id are left out.  Vectors of different lengths are compared as if the
shorter one ended in zeros.  Every row is a candidate, repeated rows as often as they come, but rows of
one id are never each other's.  Query rows of one id share one list of k: the
highest of all their scores.  Ties go to the smaller vec_id.
Scores are exact: sums beyond 2**53 use 64-bit integers.  No rows or no queries
give no rows.  Extra columns are dropped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from surfrank.llm.tables import table, written

TOP = 20
BLOCK_ROWS = 256
#: Vectors of a range (a group of blocks), queries of a part, vectors of the pilot.
RANGE_ROWS, PART_ROWS, PILOT_ROWS = 4096, 1024, 4096
#: How far ranges and parts grow with the input, and the ranges and parts that there should be before they do.
LARGEST_RANGE, LARGEST_PART, MANY_RANGES, MANY_PARTS = 32768, 16384, 8, 1
#: Queries scored at once in a cell, and groups whose bounds are tested in one task.
SLICE, GROUPS_TESTED = 1024, 1024


def _quantised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, vectors = [], []
        for vec_id, v in zip(batch.column("vec_id").to_pylist(), batch.column("embedding")):
            v = v.values if v.is_valid else None
            if v is None or v.null_count:
                continue
            x = np.asarray(v, dtype=np.float64)
            if not np.isfinite(x).all():
                continue
            ids.append(vec_id)
            vectors.append(np.clip(np.floor(x * 64), -(2.0**63), 2.0**63 - 1024).astype("<i8").tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(vectors, pa.binary())], names=["vec_id", "v"])


def quantise(vectors: DataFrame) -> DataFrame:
    """(vec_id, v): 64-bit integers of the vectors that take part."""
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")).where("vec_id IS NOT NULL AND embedding IS NOT NULL").mapInArrow(_quantised, "vec_id long, v binary")


def _matrix(rows: list[bytes], dim: int) -> np.ndarray:
    out = np.zeros((len(rows), dim), dtype=np.int64)
    for k, r in enumerate(rows):
        own = np.frombuffer(r, dtype="<i8")
        out[k, : len(own)] = own
    return out


BLOCK = ["ids", "times", "vectors", "largest", "least"]


def _blocks(dim: int, block_rows: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[int] = []
        times: list[int] = []
        rows: list[bytes] = []

        def block(k):
            m = _matrix(rows[:k], dim)
            own = (np.array(ids[:k], dtype="<i8"), np.array(times[:k], dtype="<i8"), m, m.max(axis=0), m.min(axis=0))
            del ids[:k], times[:k], rows[:k]
            return pa.RecordBatch.from_arrays([pa.array([a.tobytes()]) for a in own], names=BLOCK)

        for batch in batches:
            ids += batch.column("vec_id").to_pylist()
            times += batch.column("n").to_pylist()
            rows += batch.column("v").to_pylist()
            while len(ids) >= block_rows:
                yield block(block_rows)
        if ids:
            yield block(len(ids))

    return pack


def dot(q: np.ndarray, m: np.ndarray) -> np.ndarray:
    """q @ m.T, exact; in floating point where every partial sum is below 2**53."""
    top = float(np.abs(q.astype(np.float64)).max(initial=0)) * float(np.abs(m.astype(np.float64)).max(initial=0)) * q.shape[1]
    if top < 2.0**53:
        return (q.astype(np.float64) @ m.T.astype(np.float64)).astype(np.int64)
    return q @ m.T


def _bounds(q: np.ndarray, largest: np.ndarray, least: np.ndarray) -> np.ndarray:
    return dot(np.maximum(q, 0), largest) + dot(np.minimum(q, 0), least)


LOWEST = np.iinfo(np.int64).min


def search(q_ids: np.ndarray, q: np.ndarray, floor: np.ndarray, blocks: list[tuple], k: int) -> tuple[np.ndarray, ...]:
    """(query index, vec_id, times, score) of all scores of these blocks (ids, times, vectors, largest, least) that can still be among the k highest.

    floor: a k-th score that each query already has elsewhere.
    """
    bounds = _bounds(q, np.stack([b[3] for b in blocks]), np.stack([b[4] for b in blocks]))
    order = np.argsort(-bounds, axis=1, kind="stable")
    kept = np.full((len(q), k), LOWEST)  # the k highest scores so far, in no order
    floor = floor.copy()
    hits = []
    active = np.arange(len(q))
    for turn in range(len(blocks)):
        mine = order[active, turn]
        going = bounds[active, mine] >= floor[active]
        active, mine = active[going], mine[going]
        if len(active) == 0:
            break
        for b in np.unique(mine):
            who = active[mine == b]
            ids, times, m = blocks[b][:3]
            s = dot(q[who], m)
            other = ids[None, :] != q_ids[who][:, None]
            s = np.where(other, s, LOWEST)
            at, col = np.nonzero((s >= floor[who][:, None]) & other)
            hits.append((who[at], ids[col], times[col], s[at, col]))
            both = np.concatenate([kept[who], s], axis=1)
            kept[who] = np.partition(both, both.shape[1] - k, axis=1)[:, -k:]
            floor[who] = np.maximum(floor[who], kept[who].min(axis=1))
    if not hits:
        empty = np.zeros(0, dtype=np.int64)
        return empty, empty, empty, empty
    query, ids, times, scores = (np.concatenate(x) for x in zip(*hits))
    by = np.lexsort((ids, -scores, query))
    by = by[scores[by] >= floor[query[by]]]
    first = np.searchsorted(query[by], query[by], side="left")
    by = by[np.arange(len(by)) - first < k]
    return query[by], ids[by], times[by], scores[by]


def _cell(dim: int, k: int):
    def cell(queries: pa.Table, blocks: pa.Table) -> pa.Table:
        rows = []
        for own in zip(*(blocks.column(c).to_pylist() for c in BLOCK)):
            ids, times, m, hi, lo = (np.frombuffer(x, dtype="<i8") for x in own)
            rows.append((ids, times, m.reshape(-1, dim), hi, lo))
        found = [pa.table({c: pa.array([], pa.int64()) for c in FOUND})]
        for a in range(0, queries.num_rows if rows else 0, SLICE):
            some = queries.slice(a, SLICE)
            q_ids, n, floor = (np.array(some.column(c).to_pylist(), dtype=np.int64) for c in ("vec_id", "n", "floor"))
            at, ids, times, scores = search(q_ids, _matrix(some.column("v").to_pylist(), dim), floor, rows, k)
            found.append(pa.table(dict(zip(FOUND, (q_ids[at], ids, scores, np.minimum(n[at], k) * np.minimum(times, k))))))
        return pa.concat_tables(found)

    return cell


FOUND = ["query_id", "vec_id", "score", "times"]


def _group_bounds(dim: int):
    def bounds(blocks: pa.Table) -> pa.Table:
        largest, least = (_matrix(blocks.column(c).to_pylist(), dim) for c in ("largest", "least"))
        return pa.table({"group": blocks.column("group")[:1], "largest": pa.array([largest.max(axis=0).tobytes()]), "least": pa.array([least.min(axis=0).tobytes()])})

    return bounds


def _reached(dim: int):
    """The queries that reach a group of these, with the groups that they reach."""

    def reached(queries: pa.Table, groups: pa.Table) -> pa.Table:
        largest, least = (_matrix(groups.column(c).to_pylist(), dim) for c in ("largest", "least"))
        numbers = np.array(groups.column("group").to_pylist(), dtype=np.int64)
        lists = []
        for a in range(0, queries.num_rows, SLICE):
            some = queries.slice(a, SLICE)
            can = _bounds(_matrix(some.column("v").to_pylist(), dim), largest, least) >= np.array(some.column("floor").to_pylist(), dtype=np.int64)[:, None]
            lists += [numbers[c] for c in can]
        out = queries.select(["vec_id", "v", "n", "floor", "part"]).append_column("groups", pa.array(lists, pa.list_(pa.int64())))
        return out.filter(pa.array([len(x) > 0 for x in lists], pa.bool_()))

    return reached


def _floors(pilot_ids: np.ndarray, pilot: np.ndarray, dim: int, k: int):
    def floors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.full(batch.num_rows, LOWEST)
            ids = np.array(batch.column("vec_id").to_pylist(), dtype=np.int64)
            if batch.num_rows and len(pilot_ids) > k:
                for a in range(0, len(ids), PART_ROWS):
                    s = dot(_matrix(batch.column("v").to_pylist()[a : a + PART_ROWS], dim), pilot)
                    s[pilot_ids[None, :] == ids[a : a + PART_ROWS, None]] = LOWEST
                    out[a : a + PART_ROWS] = np.partition(s, s.shape[1] - k, axis=1)[:, -k]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out)], names=["vec_id", "v", "n", "floor"])

    return floors


def top_k(vectors: DataFrame, is_query, k: int = TOP, block_rows: int = BLOCK_ROWS, range_rows: int | None = None, part_rows: int | None = None, pilot_rows: int = PILOT_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k highest inner products; ``is_query`` is a condition on vec_id.

    ``range_rows`` and ``part_rows``, rows and queries of a cell, follow the input where they aren't given.
    """
    spark = vectors.sparkSession
    rows = written(quantise(vectors).groupBy("vec_id", "v").agg(F.count("*").alias("n")), "vectors")
    n, dim = rows.agg(F.count("*"), F.coalesce(F.max(F.octet_length("v")), F.lit(0))).first()
    dim = max(1, dim // 8)
    n_queries = rows.where(is_query).count()
    if not n_queries:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    range_rows = range_rows or min(LARGEST_RANGE, max(RANGE_ROWS, n // MANY_RANGES))
    part_rows = part_rows or min(LARGEST_PART, max(PART_ROWS, n_queries // MANY_PARTS))
    ranges, parts = max(1, -(-n // range_rows)), max(1, -(-n_queries // part_rows))

    share = min(1.0, pilot_rows / n)
    pilot = rows.where(F.pmod(F.xxhash64(F.lit(11), "vec_id", "v"), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))).limit(2 * pilot_rows).collect()  # bounded by pilot_rows
    pilot_ids, pilot_m = np.array([r["vec_id"] for r in pilot], dtype=np.int64), _matrix([r["v"] for r in pilot], dim)
    queries = rows.where(is_query).select("vec_id", "v", "n").mapInArrow(_floors(pilot_ids, pilot_m, dim, k), "vec_id long, v binary, n long, floor long")
    queries = queries.withColumn("part", F.pmod(F.xxhash64(F.lit(5), "vec_id", "v"), F.lit(parts)))

    packed = rows.repartitionByRange(ranges, "vec_id", "v").sortWithinPartitions("vec_id", "v").mapInArrow(_blocks(dim, block_rows), ", ".join(f"{c} binary" for c in BLOCK))
    packed = written(packed.withColumn("group", F.spark_partition_id().cast("long")), "blocks")
    bounds = packed.select("group", "largest", "least").groupBy("group").applyInArrow(_group_bounds(dim), "group long, largest binary, least binary")

    tests = -(-ranges // GROUPS_TESTED)
    each = lambda most: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(most - 1).cast("long")))
    left = queries.withColumn("test", each(tests))
    right = bounds.withColumn("test", F.col("group") % tests).withColumn("part", each(parts))
    reach = left.groupBy("part", "test").cogroup(right.groupBy("part", "test")).applyInArrow(_reached(dim), "vec_id long, v binary, n long, floor long, part long, groups array<long>")
    reach = written(reach, "reach")

    left = reach.withColumn("group", F.explode("groups")).drop("groups")
    cells = reach.select(F.col("part").alias("part"), F.explode("groups").alias("group")).distinct()
    found = left.groupBy("part", "group").cogroup(packed.join(cells, "group").groupBy("part", "group")).applyInArrow(_cell(dim, k), "query_id long, vec_id long, score long, times long")
    found = found.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.least("times", F.lit(k)))))
    best = found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return best.where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op5_topk_search(spark, sf_dir):
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


SQL = """
WITH v AS (SELECT vec_id, [CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum([x[1] * x[2] for x in list_zip(q.v, c.v)]) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 20
"""

"""Hard negatives by angular triangle filtering.

For each anchor the ``positives`` rows of its label with the highest inner products
are found, and for each of these the ``negatives`` highest rows of other labels whose score
lies between ``low`` and ``high`` percent of the positive's.  Both are searches for the
highest scores within a window [lo, hi]; for positives the window is open.

Index: the angles of each row to ``REFERENCES`` reference directions (rows drawn by a
hash, a bounded sample that decides about speed only) and its norm are stored.  Rows are
put in order of label, nearest direction and angle, and packed into blocks of
``BLOCK_ROWS`` rows of one label, with the ranges of their angles and norms; a
range of the order is a group of blocks.

Filter: by the triangle inequality the angle of two vectors is at least |s - t| and at most
s + t (and 2 pi - s - t), s and t being their angles to any one direction.  The cosines of
these limits, times the norms, bound the score; angles are widened by ``ANGLE_SLACK`` and
scores by one and a relative ``SCORE_SLACK``, more than rounding can be off.  Bounds
decide three times: about a part of the anchors and a group (other pairs aren't
shuffled), an anchor and a block, an anchor and a row.  Only rows whose bounds
overlap a window get integer scores, and these decide.  The lower end of a window rises to the
k-th score found, first in a pilot, a bounded sample of rows.

Each component x counts as floor(scale * x), at most 2**63 - 1024 in size; scores beyond 64 bits
count as the nearest 64-bit integer.  Rows with a null id or label, a null vector, or
a null or non-finite component take no part.  Vectors of different lengths are compared as
if the shorter one ended in zeros; the zero vector has score 0 with all.  Each row
is a row of its own, repeated ones too, and never its own positive; ties go to
the smaller vec_id.  A positive below 0 has an empty window.  No rows or no anchors give no
rows.  Extra columns are dropped.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from surfrank.llm.tables import table, written

SCALE = 256
POSITIVES, NEGATIVES, LOW, HIGH = 5, 3, 50, 95
REFERENCES, BLOCK_ROWS = 16, 64
#: Anchors of a part, rows of a group and of the pilot, on average; all at most as many as fit into CELL_BYTES.
PART_ANCHORS, GROUP_ROWS, PILOT_ROWS, CELL_BYTES = 2048, 16384, 4096, 16 << 20
#: Radians and relative score by which bounds are widened; rounding of the stored angles is below 1e-6.
ANGLE_SLACK, SCORE_SLACK = 1e-5, 1e-9
LOWEST, HIGHEST = -(2**63) + 1, 2**63 - 1


def _quantised(scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, vectors = [], []
            for k, v in enumerate(batch.column("embedding")):
                v = v.values
                if v.null_count:
                    continue
                x = np.asarray(v, dtype=np.float64)
                if not np.isfinite(x).all():
                    continue
                keep.append(k)
                with np.errstate(over="ignore"):  # clipped below
                    vectors.append(np.clip(np.floor(x * scale), -(2.0**63) + 1024, 2.0**63 - 1024).astype("<i8").tobytes())
            rows = batch.select(["vec_id", "label"]).take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(vectors, pa.binary())], names=["vec_id", "label", "v"])

    return run


def quantise(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(row, vec_id, label, v): the rows that take part, numbered, with 64-bit integers as bytes."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("embedding"))
    rows = rows.where("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL").mapInArrow(_quantised(scale), "vec_id long, label long, v binary")
    return written(rows.withColumn("row", F.monotonically_increasing_id()), "vectors")


def _matrix(rows: list[bytes], dim: int) -> np.ndarray:
    out = np.zeros((len(rows), dim), dtype=np.int64)
    for k, r in enumerate(rows):
        own = np.frombuffer(r, dtype="<i8")
        out[k, : len(own)] = own
    return out


def _long(column: pa.Array) -> np.ndarray:
    return np.array(column.to_pylist(), dtype=np.int64)


def _scores(q: np.ndarray, m: np.ndarray) -> np.ndarray:
    """q @ m.T, exact: in floating point where every partial sum is below 2**53, else in integers as wide as needed."""
    top = float(np.abs(q.astype(np.float64)).max(initial=0)) * float(np.abs(m.astype(np.float64)).max(initial=0)) * q.shape[1]
    if top < 2.0**53:
        return (q.astype(np.float64) @ m.T.astype(np.float64)).astype(np.int64)
    if top < 2.0**62:
        return q @ m.T
    return np.clip(q.astype(object) @ m.T.astype(object), LOWEST, HIGHEST).astype(np.int64)


@dataclass
class Vectors:
    """Vectors with norms and angles to the directions."""

    row: np.ndarray
    vec_id: np.ndarray
    m: np.ndarray
    norm: np.ndarray
    angles: np.ndarray

    @staticmethod
    def of(rows, directions: np.ndarray) -> "Vectors":
        """From columns row, vec_id and v."""
        m = _matrix(rows.column("v").to_pylist(), directions.shape[1])
        return Vectors(_long(rows.column("row")), _long(rows.column("vec_id")), m, *measured(m, directions))


def measured(m: np.ndarray, directions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Norms of integer vectors and their angles to unit directions; the zero vector has right angles."""
    x = m.astype(np.float64)
    size = np.abs(x).max(axis=1, initial=0)
    unit = x / np.maximum(size, 1)[:, None]  # so that squares stay finite
    norm = np.sqrt((unit * unit).sum(axis=1))
    cosines = (unit / np.maximum(norm, 1e-300)[:, None]) @ directions.T
    return norm * np.maximum(size, 1), np.arccos(np.clip(cosines, -1, 1)).astype(np.float32)


def limits(norms, angles_low, angles_high, most) -> tuple[np.ndarray, np.ndarray]:
    """(lower, upper) of scores from products of norms (least, most) and the least and largest angle."""
    high, low = np.cos(np.maximum(angles_low - ANGLE_SLACK, 0)), np.cos(np.minimum(angles_high + ANGLE_SLACK, np.pi))
    slack = 1 + SCORE_SLACK * most
    return np.where(low >= 0, norms, most) * low - slack, np.where(high >= 0, most, norms) * high + slack


def bounds(q_norm, q_angles, norm_low, norm_high, angles_low, angles_high) -> tuple[np.ndarray, np.ndarray]:
    """(lower, upper) of the scores of all queries with all rows or blocks, whose norms and angles lie in the given ranges."""
    least = np.zeros((len(q_norm), len(norm_low)), dtype=np.float32)
    largest = np.full_like(least, np.pi)
    for r in range(q_angles.shape[1]):
        own, a, b = q_angles[:, r, None], angles_low[None, :, r], angles_high[None, :, r]
        np.maximum(least, a - own, out=least)
        np.maximum(least, own - b, out=least)
        np.minimum(largest, own + b, out=largest)
        np.minimum(largest, np.float32(2 * np.pi) - own - a, out=largest)
    return limits(q_norm[:, None] * norm_low[None, :], least.astype(np.float64), largest.astype(np.float64), q_norm[:, None] * norm_high[None, :])


@dataclass
class Block:
    """Rows of one label."""

    label: int
    rows: Vectors


def search(q: Vectors, labels: np.ndarray, owner: np.ndarray, lo: np.ndarray, hi: np.ndarray, blocks: list[Block], k: int, same: bool):
    """(window, vec_id, score) of the k highest scores of each window [lo, hi], and the raised lower ends.

    Window w belongs to the query ``owner[w]``; rows count whose label is its (same) or isn't.
    """
    norms = [(b.rows.norm.min(), b.rows.norm.max()) for b in blocks]
    low, high = bounds(q.norm, q.angles, *map(np.array, zip(*norms)), np.stack([b.rows.angles.min(axis=0) for b in blocks]), np.stack([b.rows.angles.max(axis=0) for b in blocks]))
    floor, kept, hits, tested = lo.copy(), np.full((len(lo), k), LOWEST), [], 0
    for j in np.argsort(-high.mean(axis=0), kind="stable"):
        block = blocks[j]
        fit = ((labels[owner] == block.label) == same) & (high[owner, j] >= floor) & (low[owner, j] <= hi)
        w = np.flatnonzero(fit)
        if len(w) == 0:
            continue
        who, back = np.unique(owner[w], return_inverse=True)
        own = block.rows
        below, above = bounds(q.norm[who], q.angles[who], own.norm, own.norm, own.angles, own.angles)
        meets = (above[back] >= floor[w, None]) & (below[back] <= hi[w, None])
        some = meets.any(axis=0)
        if not some.any():
            continue
        tested += len(who) * int(some.sum())
        s = _scores(q.m[who], own.m[some])[back]
        right = (s >= floor[w, None]) & (s <= hi[w, None]) & (own.row[some][None, :] != q.row[who][back][:, None])
        at, col = np.nonzero(right)
        if len(at) == 0:
            continue
        ids, scores = own.vec_id[some][col], s[at, col]
        order = np.lexsort((ids, -scores, at))
        at, ids, scores = at[order], ids[order], scores[order]
        place = np.arange(len(at)) - np.searchsorted(at, at, side="left")
        best = place < k
        at, ids, scores, place = at[best], ids[best], scores[best], place[best]
        hits.append((w[at], ids, scores))
        changed, line = np.unique(at, return_inverse=True)
        new = np.full((len(changed), k), LOWEST)
        new[line, place] = scores
        rows = w[changed]
        kept[rows] = np.sort(np.concatenate([kept[rows], new], axis=1), axis=1)[:, -k:]
        floor[rows] = np.maximum(floor[rows], kept[rows][:, 0])
    if not hits:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none, floor, tested
    w, ids, scores = (np.concatenate(x) for x in zip(*hits))
    fit = scores >= floor[w]
    w, ids, scores = w[fit], ids[fit], scores[fit]
    order = np.lexsort((ids, -scores, w))
    w, ids, scores = w[order], ids[order], scores[order]
    best = np.arange(len(w)) - np.searchsorted(w, w, side="left") < k
    return w[best], ids[best], scores[best], floor, tested


def _queries(rows, directions: np.ndarray):
    """(vectors, labels, owner, no, lo, hi) of rows with lists no, lo and hi of their windows."""
    lists = [rows.column(c).to_pylist() for c in ("no", "lo", "hi")]
    owner = np.repeat(np.arange(len(lists[0])), [len(x) for x in lists[0]])
    return Vectors.of(rows, directions), _long(rows.column("label")), owner, *(np.array([x for own in xs for x in own], dtype=np.int64) for xs in lists)


def _floored(directions: np.ndarray, pilot: list[Block], k: int, same: bool):
    """Raises the lower end of each window to its k-th score in the pilot, and drops empty windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            q, labels, owner, no, lo, hi = _queries(batch, directions)
            floor = search(q, labels, owner, lo, hi, pilot, k, same)[3] if pilot else lo
            real = lo <= hi
            ends = np.concatenate([[0], np.cumsum(np.bincount(owner[real], minlength=len(labels)))]).astype(np.int32)
            angles = pa.ListArray.from_arrays(pa.array(np.arange(len(labels) + 1, dtype=np.int32) * q.angles.shape[1]), pa.array(q.angles.ravel()))
            lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(x[real])) for x in (no.astype(np.int32), floor, hi)]
            out = pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("row", "vec_id", "label", "v")), pa.array(q.norm), angles, pa.array(q.angles.argmin(axis=1).astype(np.int64)), *lists], names=["row", "vec_id", "label", "v", "norm", "angles", "near", "no", "lo", "hi"])
            yield out.filter(pa.array(np.diff(ends) > 0))

    return run


def _indexed(directions: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, angles = measured(_matrix(batch.column("v").to_pylist(), directions.shape[1]), directions)
            near = angles.argmin(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(near.astype(np.int64)), pa.array(angles[np.arange(len(near)), near].astype(np.float64))], names=["row", "vec_id", "label", "v", "near", "angle"])

    return run


_BLOCK = "group long, label long, rows binary, ids binary, vectors binary, norms binary, angles binary, low array<float>, high array<float>, norm_low double, norm_high double"


def _packed(directions: np.ndarray, block_rows: int):
    """Sorted rows of a partition in blocks of one label; the partition is the group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group = TaskContext.get().partitionId()
        held: list[tuple] = []

        def block():
            part = pa.table(dict(zip(("row", "vec_id", "label", "v"), zip(*held))))
            x = Vectors.of(part, directions)
            row = (group, held[0][2], x.row.tobytes(), x.vec_id.tobytes(), x.m.tobytes(), x.norm.tobytes(), x.angles.tobytes(), x.angles.min(axis=0), x.angles.max(axis=0), x.norm.min(), x.norm.max())
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([c]) for c in row], names=[c.split()[0] for c in _BLOCK.split(", ")])

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("row", "vec_id", "label", "v"))):
                if held and (held[0][2] != row[2] or len(held) == block_rows):
                    yield block()
                held.append(row)
        if held:
            yield block()

    return run


def _cell(directions: np.ndarray, k: int, same: bool):
    dim, n = directions.shape[1], len(directions)

    def cell(queries: pa.Table, rows: pa.Table) -> pa.Table:
        blocks = []
        for label, *parts in zip(*(rows.column(c).to_pylist() for c in ("label", "rows", "ids", "vectors", "norms", "angles"))):
            row, ids, m, norms, angles = (np.frombuffer(x, dtype=t) for x, t in zip(parts, ("<i8", "<i8", "<i8", "<f8", "<f4")))
            blocks.append(Block(label, Vectors(row, ids, m.reshape(-1, dim), norms, angles.reshape(-1, n))))
        if not blocks or not len(queries):
            return pa.table({"row": pa.array([], pa.int64()), "no": pa.array([], pa.int32()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.int64())})
        q, labels, owner, no, lo, hi = _queries(queries, directions)
        w, ids, scores, _, _ = search(q, labels, owner, lo, hi, blocks, k, same)
        return pa.table({"row": pa.array(q.row[owner[w]]), "no": pa.array(no[w].astype(np.int32)), "vec_id": pa.array(ids), "score": pa.array(scores)})

    return cell


class Index:
    """Blocks of the rows of a table of integer vectors, and searches in them."""

    def __init__(self, rows: DataFrame, references: int = REFERENCES, block_rows: int = BLOCK_ROWS, group_rows: int = GROUP_ROWS, part_anchors: int = PART_ANCHORS, pilot_rows: int = PILOT_ROWS):
        n, width = rows.agg(F.count("*"), F.coalesce(F.max(F.octet_length("v")), F.lit(0))).first()
        dim = max(1, width // 8)
        fit = max(1, CELL_BYTES // (8 * dim))
        self.rows, self.n, self.part_anchors = rows, n, min(part_anchors, fit)
        drawn = rows.select("row", "vec_id", "label", "v").orderBy(F.xxhash64(F.lit(7), "row"), "row")
        sample = drawn.limit(min(pilot_rows, fit)).toArrow() if n else None  # at most CELL_BYTES, or one vector
        first = _matrix(sample.column("v").to_pylist()[: 4 * references], dim).astype(np.float64) if n else np.zeros((0, dim))
        first = first[np.abs(first).max(axis=1, initial=0) > 0][:references]
        if len(first) == 0:
            first = np.eye(1, dim)
        first = first / np.abs(first).max(axis=1)[:, None]
        self.directions = first / np.sqrt((first * first).sum(axis=1))[:, None]
        self.pilot: list[Block] = []
        if n:
            labels = _long(sample.column("label"))
            self.pilot = [Block(int(x), Vectors.of(sample.filter(pa.array(labels == x)), self.directions)) for x in np.unique(labels)]
            groups = max(1, -(-n // min(group_rows, fit)))
            placed = rows.select("row", "vec_id", "label", "v").mapInArrow(_indexed(self.directions), "row long, vec_id long, label long, v binary, near long, angle double")
            order = ["label", "near", "angle", "row"]
            placed = placed.repartitionByRange(groups, *order).sortWithinPartitions(*order)
            self.blocks = written(placed.mapInArrow(_packed(self.directions, block_rows), _BLOCK), "blocks")

    def _parts(self, queries: DataFrame) -> DataFrame:
        """Queries with their part: neighbours in order of label and nearest direction, in parts of about equal size."""
        key = F.col("label") * len(self.directions) + F.col("near")
        n = -(-queries.count() // self.part_anchors)
        if n <= 1:
            return queries.withColumn("part", F.lit(0))
        cuts = queries.agg(F.percentile_approx(key, [k / n for k in range(1, n)], F.lit(100 * n))).first()[0]
        cuts = F.array(*[F.lit(c) for c in cuts])
        before, equal = F.size(F.filter(cuts, lambda c: c < key)), F.size(F.filter(cuts, lambda c: c == key))
        return queries.withColumn("part", (before + F.pmod(F.xxhash64("row"), equal + 1)).cast("int"))

    def _cells(self, queries: DataFrame, same: bool) -> DataFrame:
        """(group, part) of the groups and parts whose bounds overlap."""
        directions = range(len(self.directions))
        per = lambda f, c: F.array(*[f(F.col(c)[r]) for r in directions])
        groups = self.blocks.groupBy("group").agg(per(F.min, "low").alias("g_low"), per(F.max, "high").alias("g_high"), F.min("norm_low").alias("g_least"), F.max("norm_high").alias("g_most"), F.min("label").alias("g_first"), F.max("label").alias("g_last"))
        parts = queries.groupBy("part").agg(
            per(F.min, "angles").alias("q_low"), per(F.max, "angles").alias("q_high"), F.min("norm").alias("q_least"), F.max("norm").alias("q_most"),
            F.min("label").alias("q_first"), F.max("label").alias("q_last"), F.min(F.array_min("lo")).cast("double").alias("lo"), F.max(F.array_max("hi")).cast("double").alias("hi"),
        )
        parts = written(parts, "parts")
        last = parts.agg(F.max("part")).first()[0] or 0
        cells = groups.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(last)))).join(parts, "part")
        # the same limits as in ``bounds`` and ``limits``, for ranges on both sides
        least = F.expr("aggregate(sequence(0, size(g_low) - 1), 0D, (m, r) -> greatest(m, CAST(g_low[r] - q_high[r] AS DOUBLE), CAST(q_low[r] - g_high[r] AS DOUBLE)))")
        largest = F.expr("aggregate(sequence(0, size(g_low) - 1), pi(), (m, r) -> least(m, CAST(g_high[r] + q_high[r] AS DOUBLE), 2 * pi() - CAST(g_low[r] + q_low[r] AS DOUBLE)))")
        high, low = F.cos(F.greatest(least - ANGLE_SLACK, F.lit(0.0))), F.cos(F.least(largest + ANGLE_SLACK, F.pi()))
        norms, most = F.col("g_least") * F.col("q_least"), F.col("g_most") * F.col("q_most")
        slack = F.lit(1.0) + SCORE_SLACK * most
        overlap = (F.when(high >= 0, most).otherwise(norms) * high + slack >= F.col("lo") * (1 - F.signum("lo") * SCORE_SLACK)) & (F.when(low >= 0, norms).otherwise(most) * low - slack <= F.col("hi") * (1 + F.signum("hi") * SCORE_SLACK))
        if same:
            labels = (F.col("g_first") <= F.col("q_last")) & (F.col("q_first") <= F.col("g_last"))
        else:
            labels = ~((F.col("g_first") == F.col("g_last")) & (F.col("q_first") == F.col("q_last")) & (F.col("g_first") == F.col("q_first")))
        return written(cells.where(overlap & labels).select("group", "part"), "cells")

    def highest(self, queries: DataFrame, k: int, same: bool) -> DataFrame:
        """(row, no, vec_id, score, rank): the k highest scores in each window of ``queries`` (row, vec_id, label, v, no, lo, hi; the last three lists)."""
        floored = _floored(self.directions, self.pilot, k, same)
        queries = queries.select("row", "vec_id", "label", "v", "no", "lo", "hi").mapInArrow(floored, "row long, vec_id long, label long, v binary, norm double, angles array<float>, near long, no array<int>, lo array<long>, hi array<long>")
        queries = written(self._parts(written(queries, "floored")), "queries")
        cells = self._cells(queries, same)
        left = queries.drop("norm", "angles", "near").join(cells, "part")
        right = self.blocks.select("group", "label", "rows", "ids", "vectors", "norms", "angles").join(cells, "group")
        found = left.groupBy("group", "part").cogroup(right.groupBy("group", "part")).applyInArrow(_cell(self.directions, k, same), "row long, no int, vec_id long, score long")
        best = F.row_number().over(Window.partitionBy("row", "no").orderBy(F.desc("score"), "vec_id"))
        return found.withColumn("rank", best).where(F.col("rank") <= k)


_RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def mine(vectors: DataFrame, is_anchor, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, scale: int = SCALE, **sizes: int) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score; ``vectors`` has vec_id, label, embedding, and ``is_anchor`` is a condition on vec_id."""
    rows = quantise(vectors, scale)
    index = Index(rows, **sizes)
    anchors = rows.where(is_anchor)
    if not index.n or anchors.isEmpty():
        return vectors.sparkSession.createDataFrame([], _RESULT)
    lists = lambda no, lo, hi: [F.array(no.cast("int")).alias("no"), F.array(lo).alias("lo"), F.array(hi).alias("hi")]
    found = index.highest(anchors.select("*", *lists(F.lit(0), F.lit(LOWEST), F.lit(HIGHEST))), positives, same=True)
    found = written(found.select("row", F.col("rank").cast("int").alias("no"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    # scores x of at least low and at most high percent of s, s not negative; exact beyond 64 bits
    percent = lambda c, up: F.expr(f"(CAST(positive_score AS DECIMAL(20, 0)) * CAST({c} AS DECIMAL(10, 0)) + {99 * up}) DIV CAST(100 AS DECIMAL(31, 0))")
    windows = found.where("positive_score >= 0").select("row", F.struct("no", percent(low, 1).alias("lo"), percent(high, 0).alias("hi")).alias("w"))
    windows = windows.groupBy("row").agg(F.sort_array(F.collect_list("w")).alias("w"))  # at most ``positives`` of each anchor
    windows = anchors.join(windows, "row").select("row", "vec_id", "label", "v", F.col("w.no").alias("no"), F.col("w.lo").alias("lo"), F.col("w.hi").alias("hi"))
    hard = index.highest(windows, negatives, same=False).select("row", "no", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    out = hard.join(found, ["row", "no"]).join(anchors.select("row", F.col("vec_id").alias("anchor_id")), "row")
    return out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op11_hard_negatives(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(vectors.withColumn("label", label), F.col("vec_id") % 50 == 0)


SQL = """
WITH v AS (SELECT row_number() OVER () AS rid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT a.rid, a.vec_id AS anchor_id, a.label = c.label AS same, c.vec_id, CAST(list_sum([x[1] * x[2] for x in list_zip(a.v, c.v)]) AS BIGINT) AS score
      FROM v a JOIN v c ON a.vec_id % 50 = 0 AND a.rid <> c.rid),
p AS (SELECT rid, anchor_id, vec_id AS positive_id, score AS positive_score, row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id) AS no FROM s WHERE same QUALIFY no <= 5),
n AS (SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score, row_number() OVER (PARTITION BY p.rid, p.no ORDER BY s.score DESC, s.vec_id) AS rank
      FROM p JOIN s ON p.rid = s.rid AND NOT s.same AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
"""

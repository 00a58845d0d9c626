"""Hard negatives against brute force: windows, ties, copies, odd vectors; the bounds hold and do skip rows."""

import random

import numpy as np
from pyspark.sql import functions as F

from surfrank.llm import negatives, queries

RNG = random.Random(11)
COLUMNS = "vec_id long, label int, embedding array<double>, row int, part int, score double"


def brute_force(rows, every, positives=5, negatives_=3, low=50, high=95, scale=256):
    ok = [(d, y, [int(np.floor(x * scale)) for x in v]) for d, y, v in rows if d is not None and y is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for i, (a, y, v) in enumerate(ok):
        if a % every:
            continue
        scored = sorted((-sum(p * q for p, q in zip(v, w)), d, z) for j, (d, z, w) in enumerate(ok) if j != i)
        for s, p, z in [x for x in scored if x[2] == y][:positives]:
            fit = [(t, n) for t, n, z in scored if z != y and low * -s <= 100 * -t <= high * -s]
            out += [(a, p, k, n, -s, -t) for k, (t, n) in enumerate(fit[:negatives_], 1)]
    return sorted(out)


def corpus():
    centres = [[RNG.gauss(0, 1) for _ in range(6)] for _ in range(5)]
    rows = [(k, RNG.randrange(4), [c + RNG.gauss(0, 0.4) for c in centres[k % 5]]) for k in range(150)]
    rows += [(200 + k, k % 2, centres[0]) for k in range(60)]  # a third are copies: ties at every score
    rows += [(300, None, centres[1]), (310, 1, None), (320, 1, [1.0, None]), (330, 1, [float("nan")] * 6), (340, 1, [float("inf")]), (None, 1, centres[1])]
    rows += [(350, 2, [0.0] * 6), (360, 2, []), (370, 2, [1.0, 2.0]), (380, 3, [-x for x in centres[0]]), (20, rows[20][1], rows[20][2]), (390, 9, centres[2]), (400, 3, [0.1])]
    return rows


def test_against_brute_force(spark):
    rows = corpus()
    table = spark.createDataFrame([(*r, 1, 2, 0.5) for r in rows], COLUMNS)
    want = brute_force(rows, 10)
    for sizes in ({}, {"block_rows": 4, "group_rows": 40, "part_anchors": 5, "pilot_rows": 20, "references": 3}):
        got = negatives.mine(table, F.col("vec_id") % 10 == 0, **sizes)
        assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
        assert sorted(map(tuple, got.collect())) == want and len(want) > 100
    assert negatives.mine(table.limit(0), F.col("vec_id") % 10 == 0).count() == 0
    assert negatives.mine(table, F.col("vec_id") == -1).count() == 0


def test_scores_past_53_bits_are_exact(spark):
    rows = [(k, k % 2, [RNG.randrange(-(2**40), 2**40) / 256 for _ in range(3)]) for k in range(30)] + [(100, 0, [2.0**21, 2.0**21, 0.0]), (101, 0, [2.0**21, 2.0**21 + 1 / 256, 0.0])]
    rows = [(d, y, [x / 1024 for x in v]) for d, y, v in rows]
    table = spark.createDataFrame([(*r, 1, 2, 0.5) for r in rows], COLUMNS)
    assert sorted(map(tuple, negatives.mine(table, F.col("vec_id") % 5 == 0).collect())) == brute_force(rows, 5)
    huge = np.array([[2**63 - 1024, 2**63 - 1024]])
    assert negatives._scores(huge, huge).tolist() == [[negatives.HIGHEST]] and negatives._scores(huge, -huge).tolist() == [[negatives.LOWEST]]


def vectors(m, directions):
    return negatives.Vectors(np.arange(len(m)), np.arange(len(m)), m, *negatives.measured(m, directions))


def test_bounds_hold():
    rng = np.random.default_rng(3)
    directions = rng.normal(size=(4, 5))
    directions /= np.sqrt((directions**2).sum(axis=1))[:, None]
    m = np.concatenate([rng.integers(-300, 300, size=(60, 5)), np.floor(directions * 10**6).astype(np.int64), np.zeros((1, 5), dtype=np.int64), rng.integers(-(2**40), 2**40, size=(20, 5))])
    m = np.concatenate([m, -m, 3 * m])
    x = vectors(m, directions)
    score = m.astype(object) @ m.T.astype(object)
    low, high = negatives.bounds(x.norm, x.angles, x.norm, x.norm, x.angles, x.angles)
    assert (low <= score.astype(float)).all() and (score.astype(float) <= high).all()
    for a in range(0, len(m), 7):  # ranges of several rows
        b = slice(a, a + 7)
        low, high = negatives.bounds(x.norm, x.angles, *(np.array([f(x.norm[b])]) for f in (np.min, np.max)), *(f(x.angles[b], axis=0)[None] for f in (np.min, np.max)))
        assert (low <= score[:, b].astype(float)).all() and (score[:, b].astype(float) <= high).all()


def test_rows_outside_of_the_windows_are_not_scored():
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(8, 16)) * 100
    m = np.floor(np.repeat(centres, 64, axis=0) + rng.normal(size=(512, 16)) * 3).astype(np.int64)
    directions = centres / np.sqrt((centres**2).sum(axis=1))[:, None]
    x = vectors(m, directions)
    part = lambda b: negatives.Vectors(x.row[b], x.vec_id[b], x.m[b], x.norm[b], x.angles[b])
    blocks = [negatives.Block(0, part(slice(a, a + 32))) for a in range(0, 512, 32)]
    q, n = part(slice(0, 512, 16)), 32
    w, ids, scores, floor, tested = negatives.search(q, np.zeros(n, dtype=np.int64), np.arange(n), np.full(n, negatives.LOWEST), np.full(n, negatives.HIGHEST), blocks, 3, True)
    exact = q.m @ m.T
    exact[np.arange(n), q.row] = negatives.LOWEST
    assert scores.reshape(n, 3).tolist() == (-np.sort(-exact, axis=1)[:, :3]).tolist()
    assert tested < 0.4 * n * 512  # pairs that got integer scores


def test_parts_and_groups_that_cannot_meet_are_not_shuffled(spark):
    rows = [(k, k % 2, [100.0 * (k % 8 == j) + RNG.random() for j in range(8)]) for k in range(400)]
    table = spark.createDataFrame([(*r, 1, 2, 0.5) for r in rows], COLUMNS)
    index = negatives.Index(negatives.quantise(table), group_rows=50, part_anchors=4, block_rows=8)
    anchors = index.rows.where("vec_id % 10 = 0")
    lists = [F.array(F.lit(0)).alias("no"), F.array(F.lit(negatives.LOWEST)).alias("lo"), F.array(F.lit(negatives.HIGHEST)).alias("hi")]
    queries_ = anchors.select("*", *lists).mapInArrow(negatives._floored(index.directions, index.pilot, 2, True), "row long, vec_id long, label long, v binary, norm double, angles array<float>, near long, no array<int>, lo array<long>, hi array<long>")
    parted = index._parts(queries_)
    n_parts, n_groups = parted.select("part").distinct().count(), index.blocks.select("group").distinct().count()
    assert 1 < n_parts and index._cells(parted, True).count() < 0.5 * n_parts * n_groups


def test_query_equals_its_sql(spark):
    import duckdb

    con = duckdb.connect()
    con.execute("CREATE VIEW embeddings AS SELECT * FROM read_parquet('/root/testdata/sf0.01/embeddings.parquet')")
    df = queries.queries()["op11_hard_negatives"](spark, "/root/testdata/sf0.01")
    res = con.sql(queries.oracle_sql()["op11_hard_negatives"])
    assert df.columns == res.columns and sorted(map(tuple, df.collect())) == sorted(res.fetchall())

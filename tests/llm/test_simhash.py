"""SimHash near duplicates against brute force: edge cases, crowded buckets, slices of long texts."""

import random

import pytest
import xxhash
from pyspark.sql import functions as F

from surfrank.llm import queries, simhash

RNG = random.Random(13)
COLUMNS = "doc_id long, text string, fp string, component_id int, choice int"


def plain_fingerprint(text, size=3):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    runs = [words[i : i + size] for i in range(max(1, len(words) - size + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(b" ".join(r), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows, radius=2):
    """(doc_id, fp) rows -> component of each doc_id."""
    home = {d: d for d, _ in rows}

    def root(d):
        while home[d] != d:
            d = home[d]
        return d

    for i, (d, f) in enumerate(rows):
        for e, g in rows[:i]:
            if (f ^ g).bit_count() <= radius and root(d) != root(e):
                home[max(root(d), root(e))] = min(root(d), root(e))
    return {d: root(d) for d in home}


def corpus():
    words = [f"{a}{b}" for a in ("ka", "LO", "mi", "éü") for b in ("na", "So", "x", "中")]
    base = [" ".join(RNG.choice(words) for _ in range(RNG.choice((1, 2, 3, 8, 60, 200)))) for _ in range(40)]
    rows = list(enumerate(base)) + [(100 + k, base[k]) for k in range(8)]
    rows += [(200 + k, t + " tail") for k, t in enumerate(base) if len(t) > 700]
    return rows + [(300, None), (301, ""), (302, " \n\t"), (303, "Ab c"), (3, base[3]), (5, base[20]), (None, base[4]), (None, None)]


def test_against_brute_force(spark):
    rows = corpus()
    docs = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], COLUMNS)
    got = simhash.near_duplicates(docs).collect()
    assert sorted((r.doc_id or -1, r.fp % (1 << 64)) for r in got) == sorted((d or -1, plain_fingerprint(t)) for d, t in rows)
    want = plain_components([(d, plain_fingerprint(t)) for d, t in rows if d is not None])
    assert want[5] == want[20] == 5 and want[300] == want[301] == want[302] == 300
    assert all(r.component_id == want.get(r.doc_id) for r in got)
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


@pytest.mark.parametrize("bucket_rows", [1, 3, 256])
def test_crowded_buckets_lose_no_link(spark, bucket_rows):
    seeds = [RNG.getrandbits(64) for _ in range(4)] + [0, (1 << 64) - 1]
    fps = set(seeds)
    for s in seeds:
        for _ in range(40):
            x = s
            for b in RNG.sample(range(64), RNG.randint(1, 4)):
                x ^= 1 << b
            fps.add(x)
    rows = list(enumerate(sorted(fps)))
    RNG.shuffle(rows)
    table = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f, d) for d, f in rows], "fp long, node long")
    found = simhash.links(table, bucket_rows=bucket_rows).collect()
    fp = dict(rows)
    assert all((fp[r.a] ^ fp[r.b]).bit_count() <= 2 for r in found)
    got = {d: c for d, c in ((r.node, r.component) for r in simhash.components(spark.createDataFrame(found or [(0, 0)], "a long, b long")).collect())}
    assert {d: got.get(d, d) for d in fp} == plain_components(rows)


def test_two_fingerprints_within_the_radius_share_a_bucket(spark):
    for blocks in (simhash.BLOCKS, simhash.FINE_BLOCKS):
        pairs = []
        for k in range(60):
            x = y = RNG.getrandbits(64)
            for b in RNG.sample(range(64), 2):
                y ^= 1 << b
            pairs += [(k, 2 * k, x - (1 << 64) if x >> 63 else x), (k, 2 * k + 1, y - (1 << 64) if y >> 63 else y)]
        keys = simhash.bucket_keys(spark.createDataFrame([(f, n) for _, n, f in pairs], "fp long, node long"), blocks, 2)
        met = keys.groupBy("choice", "bits", (F.col("node") / 2).cast("long").alias("pair")).count().where("count = 2")
        assert met.select("pair").distinct().count() == 60


def test_slices_of_a_text_have_the_same_fingerprint(monkeypatch):
    texts = [t for _, t in corpus()]
    whole = [simhash.fingerprint((t or "").encode()) for t in texts]
    monkeypatch.setattr(simhash, "SLICE_BYTES", 7)
    assert [simhash.fingerprint((t or "").encode()) for t in texts] == whole


def test_query_returns_its_columns(spark):
    df = queries.queries()["op13_simhash_near_dedup"](spark, "/root/testdata/sf0.001")
    assert df.columns == ["doc_id", "fingerprint", "component_id"]
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    rows = {r.doc_id: r for r in df.collect()}
    assert {d: r.fingerprint for d, r in rows.items()} == {d: f"{plain_fingerprint(t):016x}" for d, t in docs.items()}
    assert {d: r.component_id for d, r in rows.items()} == plain_components([(d, int(r.fingerprint, 16)) for d, r in rows.items()])

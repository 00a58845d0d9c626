"""What op9's lists, signatures and cells hold: no unrelated documents, and every pair that is similar."""

import random

import numpy as np
import pyarrow as pa
import pytest

from surfrank.llm import neardup

RNG = random.Random(9)
WORDS = [f"w{k}" for k in range(60)]


def rows_of(texts):
    return [(k, " ".join(t)) for k, t in enumerate(texts)]


def grouped(rows, size):
    home, sets = {d: d for d, _ in rows}, [(d, neardup.shingle_set(t, size)) for d, t in rows]

    def root(d):
        while home[d] != d:
            d = home[d]
        return d

    for i, (d, s) in enumerate(sets):
        for e, t in sets[:i]:
            if 100 * len(s & t) >= 80 * len(s | t) and root(d) != root(e):
                home[max(root(d), root(e))] = min(root(d), root(e))
    return {d: root(d) for d in home}


def test_texts_of_unrelated_documents_are_not_read(spark, monkeypatch):
    texts = [[RNG.choice(WORDS) for _ in range(200)] for _ in range(300)]  # each pair of words is in about 16 of them
    texts += [[*t[:190], "x"] for t in texts[:20]]
    wanted, texts_of = set(), neardup.NearDuplicates._texts_of

    def seen(self, nodes):
        wanted.update(r.node for r in nodes.collect())
        return texts_of(self, nodes)

    monkeypatch.setattr(neardup.NearDuplicates, "_texts_of", seen)
    got = neardup.near_duplicates(spark.createDataFrame(rows_of(texts), "doc_id long, text string"), size=2).collect()
    assert {r.doc_id: r.component_id for r in got} == {k: k if k < 300 else k - 300 for k in range(320)}
    assert wanted == {*range(20), *range(300, 320)}


def test_families_in_many_cells_against_brute_force(spark, monkeypatch):
    for name, value in (("SHORT_LIST", 2), ("CELL_MEMBERS", 7), ("STRIP", 3), ("CELL_WEIGHT", 2000)):
        monkeypatch.setattr(neardup, name, value)
    texts = []
    for family in range(3):
        first = [RNG.choice(WORDS) for _ in range(120)]
        for _ in range(40):  # some similar to the first one, some to each other only, most to none
            other, changes = list(RNG.choice([first, *texts[family * 40 :]])), RNG.randint(2, 9)
            for at in RNG.sample(range(120), changes):
                other[at] = RNG.choice(WORDS)
            texts.append(other)
    rows = rows_of(texts)
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), size=2).collect()
    want = grouped(rows, 2)
    assert 3 < len(set(want.values())) < 110
    assert {r.doc_id: r.component_id for r in got} == want


@pytest.mark.parametrize("n", [5, 40, 3000])
def test_least_hashes_agree_as_sets_do(n):
    rng = np.random.default_rng(n)
    pairs, values, ends = 400, [], []
    for _ in range(pairs):
        union = rng.choice(1 << 32, n, replace=False).astype(np.uint32)
        out = n // 10
        for own in (union[: n - out], union[n - 4 * n // 5 - out if n > 9 else 1 :]):
            values.append(own)
            ends.append(len(own))
    ends = np.cumsum(ends)
    sizes = np.diff(np.concatenate([[0], ends]))
    shared = (sizes[::2] + sizes[1::2] - n) / n
    least = neardup.least_hashes(np.concatenate(values), ends, 128)
    agree = (least[:, ::2] == least[:, 1::2]).mean()
    assert abs(agree - shared.mean()) < 0.01
    keys, signed = neardup.keys_and_signatures(np.concatenate(values), ends, 80)
    assert keys.shape == (2 * pairs, neardup.bands(80)) and len(signed) == len(neardup.SIGNATURE)
    if shared.min() >= 0.7:
        assert (keys[::2] == keys[1::2]).any(axis=1).all()


def test_sets_longer_than_a_slice(monkeypatch):
    rng = np.random.default_rng(1)
    sets = [rng.integers(0, 1 << 32, k, dtype=np.uint32) for k in (1, 70, 3, 33, 1, 200)]
    values, ends = np.concatenate(sets), np.cumsum([len(x) for x in sets])
    whole = neardup.least_hashes(values, ends, 12)
    for k, own in enumerate(sets):
        assert (neardup.least_hashes(own, np.array([len(own)]), 12)[:, 0] == whole[:, k]).all()
    for most in (1, 2, 7, 33, 64):
        monkeypatch.setattr(neardup, "SLICE_VALUES", most)
        assert (neardup.least_hashes(values, ends, 12) == whole).all()
    keys, signed = neardup.keys_and_signatures(values[:0], ends[:0], 80)
    assert keys.shape[0] == 0 and [len(x) for x in signed] == [0] * len(neardup.SIGNATURE)


def test_limits_follow_the_similarity():
    assert [neardup.bands(p) for p in (50, 80, 95, 100)] == [261, 32, 10, 1]
    assert [neardup.most_differing(p) for p in (80, 100)] == [27, 0]


def test_cell_of_signatures(monkeypatch):
    monkeypatch.setattr(neardup, "STRIP", 2)
    same, other = 0, -1  # in all fields, in none
    rows = {
        "side": [0, 0, 0, 1, 1, 1],
        "node": [1, 2, 3, 4, 5, 6],
        "component": [1, 2, 3, 4, 2, 6],
        "n": [100, 100, 100, 81, 100, 79],
        "s0": [same, same, other, same, same, same],
        "s1": [same, same, other, same, same, same],
    }
    got = neardup._signature_cell(80)(pa.table({"c": [9] * 6, **rows}))
    assert got.to_pydict() == {"c": [9] * 4, "node": [1, 2, 4, 5]}  # 3 is unlike the others, 6 too small
    alone = {k: v[:1] + v[:1] for k, v in rows.items()} | {"side": [0, 1]}
    assert neardup._signature_cell(80)(pa.table({"c": [9, 9], **alone})).num_rows == 0

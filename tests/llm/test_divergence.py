"""Source divergence against plain Python: blocks of terms and groups, null columns, languages without kept terms."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from surfrank.llm import divergence, queries

RNG = random.Random(12)
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
COLUMNS = "doc_id long, text string, lang string, source string, value string, rank int, band int, p int"


def fold(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def brute_force(rows, min_docs, top=10):
    counts, df = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        own = Counter(TERM.findall(fold(text or "")))
        counts[lang or "", source or ""].update(own)
        df[lang or ""].update(own.keys())
    out = set()
    for lang in {g[0] for g in counts}:
        kept = [t for t, n in df[lang].items() if n >= min_docs]
        mine = {s: c for (x, s), c in counts.items() if x == lang}
        p = {}
        for s, c in [*mine.items(), (None, sum(mine.values(), Counter()))]:
            d = sum(c[t] for t in kept) + 2 * len(kept)
            p[s] = {t: 1 + 10**9 * (c[t] + 2) // d for t in kept}
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s, c in mine.items():
            pairs = [(-sum(f(p[s][t], p[o][t]) for t in kept), o) for o in mine if o != s]
            terms = [(-f(p[s][t], p[None][t]), t) for t in kept if c[t] and p[s][t] > p[None][t]]
            for part, found in (("pair", pairs), ("term", sorted(terms, key=lambda x: (x[0], x[1].encode()))[:top])):
                out |= {(lang, s, part, item, -v, k) for k, (v, item) in enumerate(sorted(found, key=lambda x: (x[0], x[1].encode())), 1)}
    return out


def corpus():
    words = ["Ab", "é", "中文", "x1y", "ZZ-top", "a_b", "ÀB", "it's", *(f"w{chr(97 + k)}" for k in range(12))]
    sources = ["s1", "S2", "", None, "é", "s10", "𝔰", "ﬀ"]
    rows = [(" ".join(RNG.choices(words, k=RNG.randint(0, 40))), RNG.choice(("en", "en", "de")), RNG.choice(sources)) for _ in range(160)]
    rows += [("only few", "xx", "s1"), (None, "xx", "S2"), ("", None, None), (None, None, "s1"), ("Ab Ab", "", "s3")] + [("", "en", "no terms")]
    rows += [("common " * 30, "en", "s1")] * 40
    return rows


@pytest.mark.parametrize("blocks", [(2048, 32), (3, 2)])
def test_against_brute_force(spark, monkeypatch, blocks):
    monkeypatch.setattr(divergence, "TERM_BLOCK", blocks[0])
    monkeypatch.setattr(divergence, "GROUP_BLOCK", blocks[1])
    rows = corpus()
    docs = spark.createDataFrame([(k % 50 or None, t, lang, source, "x", 1, 2, 3) for k, (t, lang, source) in enumerate(rows)], COLUMNS)
    got = divergence.audit(docs, min_docs=4)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == sorted(brute_force(rows, 4))
    assert divergence.audit(docs.limit(0)).count() == 0


def test_counts_past_64_bits_of_products(spark):
    df = spark.createDataFrame([(10**12, 10**13, 10**8), (0, 0, 5), (3, 0, 0)], "n long, total long, v long")
    got = [r.p for r in df.select(divergence._p("n", "total").alias("p")).collect()]
    assert got == [1 + 10**9 * (10**12 + 2) // (10**13 + 2 * 10**8), 1 + 10**9 * 2 // 10, None]


def test_joint_tables_are_exact_in_any_blocking(monkeypatch):
    levels = np.array([[RNG.choice((5, 7, 11, 13)) for _ in range(6)] for _ in range(50)])
    want = {(i, p, j, q): int(((levels[:, i] == p) & (levels[:, j] == q)).sum()) for i in range(6) for j in range(6) for p in (5, 7, 11, 13) for q in (5, 7, 11, 13)}
    for columns in (512, 5, 1):
        monkeypatch.setattr(divergence, "COLUMN_BLOCK", columns)
        blocks = divergence._indicators(levels, np.arange(6))
        got = {(int(i[r]), int(p[r]), int(j[c]), int(q[c])): int(n) for x, p, i in blocks for y, q, j in blocks for (r, c), n in np.ndenumerate(x.T @ y)}
        assert all(got.get(k, 0) == n for k, n in want.items())


def test_slices_of_a_text_have_the_same_terms(monkeypatch):
    text = "Ab é中文 x1y it's ".encode() * 40
    whole = divergence.term_counts(text)
    monkeypatch.setattr(divergence, "SLICE_BYTES", 5)
    assert divergence.term_counts(text) == whole == Counter(w.encode() for w in TERM.findall(fold(text.decode())))


def test_a_task_passes_counts_on_when_it_holds_many(monkeypatch):
    monkeypatch.setattr(divergence, "HELD_TERMS", 3)
    batch = pa.RecordBatch.from_arrays([pa.array(["l"] * 3), pa.array(["s"] * 3), pa.array([b"a b", b"a c d", b"a a"])], names=["lang", "source", "text"])
    rows = [r for out in divergence._counted(iter([batch])) for r in out.to_pylist()]
    assert sum(r["n"] for r in rows if r["term"] == "a") == 4 and sum(r["docs"] for r in rows if r["term"] == "a") == 3
    assert sum(r["term"] is None for r in rows) > 1


def test_query_equals_its_sql(spark):
    import duckdb

    con = duckdb.connect()
    con.execute("CREATE VIEW documents AS SELECT * FROM read_parquet('/root/testdata/sf0.001/documents.parquet')")
    df = queries.queries()["op12_source_divergence"](spark, "/root/testdata/sf0.001")
    res = con.sql(queries.oracle_sql()["op12_source_divergence"])
    assert df.columns == res.columns and sorted(map(tuple, df.collect())) == sorted(res.fetchall())

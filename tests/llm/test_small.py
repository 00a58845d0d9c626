"""Operators on small tables: nulls, empty and repeated rows, ties, extra columns, empty tables, brute force."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from surfrank.llm import chat, decontaminate, extract_html, langid, mixing, neardup, substring, tables, topk, toxicity, warc
from surfrank.session import scratch_path

RNG = random.Random(5)
VOCABULARY = [f"{a}{b}" for a in ("ka", "lo", "mi", "ru", "te") for b in ("na", "so", "vi", "po", "da", "x")]
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string, chunk int"


def prose(n):
    return " ".join(RNG.choice(VOCABULARY) for _ in range(n))


def corpus():
    base = [prose(RNG.randint(1, 160)) for _ in range(40)]
    passage = prose(60)
    rows = [(k, t) for k, t in enumerate(base)]
    rows += [(100 + k, base[k]) for k in range(6)]
    rows += [(200 + k, base[10 + k] + " " + prose(2)) for k in range(6)]
    rows += [(300 + k, prose(5) + "\n" + passage + "\t" + prose(7)) for k in range(5)]
    rows += [(400, None), (401, ""), (402, " \n\t"), (403, "é"), (3, base[3]), (None, base[4]), (404, "12 34 !!"), (405, prose(3000))]
    return [(d, t, "xx" if d is None or d % 2 else None, ("a", "b", None)[(d or 0) % 3], len(t or ""), "s", 7) for d, t in rows]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), DOCS)


@pytest.fixture(scope="module")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


def words(text):
    return (text or "").encode().split()


def test_substring_against_brute_force(docs, no_docs):
    window = 35
    rows = [(r.doc_id, words(r.text)) for r in docs.collect()]
    seen = Counter(tuple(w[i : i + window]) for _, w in rows for i in range(len(w) - window + 1))
    want = Counter()
    for d, w in rows:
        gone = {j for i in range(len(w) - window + 1) if seen[tuple(w[i : i + window])] > 1 for j in range(i, i + window)}
        kept = b" ".join(x for j, x in enumerate(w) if j not in gone).decode()
        want[d, len(w), len(gone), kept] += 1
    got = substring.remove_repeats(docs, keep=["doc_id", "chunk"], always_join=True, chunk_bytes=2000, bucket_bytes=3000)
    assert got.columns == ["doc_id", "chunk", "n_words", "n_removed", "kept_text"]
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got.collect()) == want
    assert sum(n for _, _, n, _ in want) > 300
    assert substring.remove_repeats(no_docs).count() == 0


def test_near_duplicates_against_brute_force(docs, no_docs, monkeypatch):
    monkeypatch.setattr(neardup, "SHORT_LIST", 2)
    monkeypatch.setattr(neardup, "CELL_WEIGHT", 600)
    rows = [(r.doc_id, neardup.shingle_set(r.text or "", 2)) for r in docs.collect() if r.doc_id is not None]
    home = {d: d for d, _ in rows}

    def root(d):
        while home[d] != d:
            d = home[d]
        return d

    for i, (d, s) in enumerate(rows):
        for e, t in rows[:i]:
            if s and t and 100 * len(s & t) >= 80 * len(s | t) and root(d) != root(e):
                home[max(root(d), root(e))] = min(root(d), root(e))
    got = neardup.near_duplicates(docs, size=2).collect()
    assert {r.doc_id: r.component_id for r in got if r.doc_id is not None} == {d: root(d) for d in home}
    assert Counter(r.n_shingles for r in got if r.doc_id is not None) == Counter(len(s) for _, s in rows)
    assert [r.component_id for r in got if r.doc_id is None] == [None] and len(got) == docs.count()
    assert neardup.near_duplicates(no_docs).count() == 0


def test_rows_of_one_document_join_their_groups(spark):
    a, b = prose(40), prose(40)
    rows = [(1, a), (5, b), (5, a), (9, b), (20, prose(40)), (21, a + " x"), (22, b + " y"), (30, prose(9)), (30, prose(9)), (31, prose(9))]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter((r.doc_id, r.component_id) for r in neardup.near_duplicates(table).collect())
    assert got == Counter({(1, 1): 1, (5, 1): 2, (9, 1): 1, (20, 20): 1, (21, 1): 1, (22, 1): 1, (30, 30): 2, (31, 31): 1})


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_rows_without_keys(spark, monkeypatch, limit):
    monkeypatch.setattr(tables, "BROADCAST_BYTES", limit)
    rows = spark.createDataFrame([(k if k % 9 else None, f"t{k}") for k in range(300)], "doc_id long, text string")
    got = tables.without(rows, spark.range(0, 300, 7).toDF("doc_id"), "doc_id")
    assert sorted(r.text for r in got.collect()) == sorted(f"t{k}" for k in range(300) if k % 9 == 0 or k % 7)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert ("SortMergeJoin" in plan) == (limit == 0)


def test_filter_before_a_join_loses_no_row(spark, monkeypatch):
    rows = spark.range(-500, 500).withColumnRenamed("id", "doc_id")
    keys = rows.where("doc_id % 7 = 0")
    want = {r.doc_id for r in keys.collect()}
    for bits in (1 << 24, 128):
        monkeypatch.setattr(tables, "FILTER_BITS", bits)
        got = {r.doc_id for r in tables.likely(rows, keys, "doc_id").collect()}
        assert want <= got and (len(got) < 150 or bits == 128)
    assert tables.likely(rows, keys.limit(0), "doc_id").count() == 0


def test_intersections_in_cells():
    sets = [np.unique(np.array([RNG.randrange(60) for _ in range(RNG.randint(0, 40))], dtype=np.uint64)) for _ in range(30)]
    got = neardup._common(sets[:12], sets[12:])
    assert got.tolist() == [[len(set(a) & set(b)) for b in sets[12:]] for a in sets[:12]]


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_decontamination(spark, docs, no_docs, monkeypatch, limit):
    monkeypatch.setattr(tables, "BROADCAST_BYTES", limit)
    item, short = prose(30), "Lona, VIX"
    bench = spark.createDataFrame([(1, item), (2, None), (3, ""), (4, short), (5, item), (6, prose(12))], "item_id long, text string")
    near = item.split()
    del near[-2:]
    more = [(900, prose(9) + " " + item.upper().replace(" ", ", ") + ". " + prose(3)), (901, prose(4) + " " + " ".join(near)), (902, "lona vix!"), (903, "lona vix " + prose(3)), (904, " ".join(item.split()[:15]) + " " + prose(20))]
    more = spark.createDataFrame([(d, t, None, None, 0, "s", 7) for d, t in more * 2], DOCS)
    found = {(r.doc_id, r.item_id): r.similarity for r in decontaminate.find_contaminated(docs.union(more), bench).collect()}
    assert found[900, 1] == found[900, 5] == found[902, 4] == 1.0
    assert found[901, 1] == pytest.approx(24 / 26) and {d for d, _ in found} == {900, 901, 902}
    left = decontaminate.remove_contaminated(docs.union(more), bench)
    assert left.columns == docs.columns and left.count() == docs.count() + 4
    assert decontaminate.find_contaminated(no_docs, bench).count() == 0
    assert decontaminate.remove_contaminated(docs, bench.limit(0)).count() == docs.count()


def test_hamming_blocks_hold_every_fingerprint_within_the_radius():
    flips = {x for x in range(1 << 16) if x.bit_count() <= decontaminate.RADIUS // decontaminate.BLOCKS}
    for _ in range(2000):
        change = sum(1 << b for b in RNG.sample(range(64), decontaminate.RADIUS))
        assert any((change >> 16 * b) & 0xFFFF in flips for b in range(4))


def test_warc_round_trip(spark):
    big = "<p>" + "x" * 1200 + "é</p>"
    rows = [(1, "http://a", big), (2, None, big), (3, "http://b\r\nX: y", ""), (4, "u", None), (5, "u", big), (None, "u", "short"), (6, "u", "a\r\n\r\nb"), (7, "u", "z" * 300_000), (8, "v", "z" * 300_000)]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, digest int")
    archives = warc.write_archives(pages, scratch_path(spark, "warc-test"), archive_bytes=500)
    got = {r.page_id: r for r in warc.read_archives(archives).collect()}
    assert all(r.digests_ok for r in got.values()) and len(got) == len(rows)
    for page_id, _, html in rows:
        raw = (html or "").encode()
        assert (got[page_id].payload_bytes, got[page_id].payload_digest) == (len(raw), hashlib.sha1(raw).hexdigest())
        assert got[page_id].payload is None or bytes(got[page_id].payload) == raw
    assert {k: r.refers_to for k, r in got.items() if r.record_type == "revisit"} == {1: 5, 2: 5, 7: 8}
    assert warc.read_archives(warc.write_archives(pages.limit(0), scratch_path(spark, "warc-test"))).count() == 0


def test_damaged_records_are_found():
    import io

    record = warc.record_bytes(1, "u", b"payload" * 50)
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    member = z.compress(record.replace(b"payloadpayload", b"payloadpaXload", 1)) + z.flush()
    ((header, block),) = list(warc.RecordStream(io.BytesIO(member)))
    assert not warc.parse_record(header, block)[-1]
    with pytest.raises(EOFError):
        list(warc.RecordStream(io.BytesIO(member[:-20])))


def test_language_id(spark, no_docs):
    rows = [(k, ("the house and the river were old " if k % 2 else "das haus und der fluss waren alt ") * 3, "en" if k % 2 else "de", 1.0) for k in range(60)]
    rows += [(100, None, "en", 1.0), (101, "123 ?!", "de", 1.0), (102, "", None, 1.0), (None, "the old river", "en", 1.0)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double")
    got = {r.doc_id: r for r in langid.identify(table.select("doc_id", "text", "lang")).collect()}
    assert all(got[k].lang_pred == ("en" if k % 2 else "de") and 0 < got[k].score <= 1 for k in range(60))
    assert [got[k].lang_pred for k in (100, 101, 102)] == ["und"] * 3 and got[None].lang_pred == "en"
    kept = langid.recognised(table)
    assert kept.columns == table.columns and kept.count() == 61
    assert langid.identify(no_docs).count() == 0


def test_gram_counts_of_slices(monkeypatch):
    text = "abc de é fgh " * 50
    whole = langid._gram_counts(text)
    monkeypatch.setattr(langid, "SLICE_CHARS", 7)
    parts = langid._gram_counts(text)
    assert (whole[0] == parts[0]).all() and (whole[1] == parts[1]).all()


def test_mixing(spark, docs, no_docs):
    laid, sources, spans = mixing.mix_documents(docs, block_words=8, shard_slots=20)
    again = mixing.mix_documents(docs, block_words=8, shard_slots=20)[2]
    plan = {r.source: r for r in sources.collect()}
    size = Counter()
    for r in docs.collect():
        size[r.source] += len(words(r.text))
    order = sorted(size, key=lambda s: (s is None, s))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    want, open_ = {}, set(order)
    while True:  # cap what is above, share the rest again
        rest = 1.5 * sum(size.values()) - sum(want.values())
        level = rest / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > 2 * size[s]}
        if not over:
            break
        want |= {s: 2.0 * size[s] for s in over}
        open_ -= over
    want |= {s: level * weight[s] for s in open_}
    assert {s: plan[s].target for s in plan} == pytest.approx(want)
    rows = spans.collect()
    taken, by_doc = Counter(), Counter()
    for r in rows:
        taken[r.source_no] += r.n_words
        by_doc[r.source_no, r.start] += r.n_words
    assert all(taken[p.source_no] == round(p.target) for p in plan.values())
    lengths = {(r.source_no, r.start): r["size"] for r in laid.where("size > 0").collect()}
    assert all(n <= 2 * lengths[k] for k, n in by_doc.items()) and laid.count() == docs.count()
    assert len({r.shard for r in rows}) > 3 and Counter(map(tuple, rows)) == Counter(map(tuple, again.collect()))
    assert mixing.mix_documents(no_docs)[2].count() == 0


def test_shards_have_fixed_sizes_and_meet_the_targets():
    for slots, size in (([1000, 50, 3], 100), ([7, 0, 1], 3), ([5], 10), ([10**12, 3 * 10**11], 10**9)):
        slots = np.array(slots)
        shards = -(-int(slots.sum()) // size)
        drawn = [mixing.dealt(k, shards, slots, size, 20) for k in range(min(shards, 40))]
        assert all(int(n.sum()) == size for _, n in drawn[: shards - 1][:39])
        at = np.zeros_like(slots)
        for first, n in drawn:
            assert (first == at).all() and (n >= 0).all()
            at = at + n
        assert shards > 40 or (at == slots).all()
    counts = np.array([mixing.dealt(k, 40, np.array([30000, 10000]), 1000, 5)[1] for k in range(40)])
    assert 10 < counts[:, 0].std() < 60 and abs(counts[:, 0].mean() - 750) < 1e-9  # multinomial shards: 13.7 each, more with the draws above


def test_mixing_broadcasts_no_slots(spark, docs):
    spans = mixing.mix_documents(docs, block_words=8, shard_slots=20)[2]
    spans.collect()
    plan = spans._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastExchange" not in plan


def test_permutations():
    for n in (1, 2, 3, 17, 64, 65, 1000):
        keys = mixing._keys(1, 2, n)
        p = mixing.permute(np.arange(n), n, keys)
        assert sorted(p.tolist()) == list(range(n))
        assert (mixing.permute(p, n, keys, inverse=True) == np.arange(n)).all()


def test_top_k_keeps_repeated_rows_as_its_sql_does(spark):
    import duckdb

    rows = [(k % 60, [RNG.uniform(-1, 1) for _ in range(4)]) for k in range(100)]
    rows += [(7, rows[7][1])] * 2 + [(20, rows[20][1])] + [(500, [0.9, 0.9, 0.9, 0.9])] * 30
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    con = duckdb.connect()
    con.register("embeddings", table.toArrow())
    want = sorted(con.sql(topk.SQL).fetchall())
    assert len(want) == 4 * 20  # ids 0, 20, 40 and 500
    assert sorted(map(tuple, topk.top_k(table, F.col("vec_id") % 20 == 0).collect())) == want
    assert sorted(map(tuple, topk.top_k(table, F.col("vec_id") % 20 == 0, block_rows=5, range_rows=9, part_rows=2, pilot_rows=40).collect())) == want


def test_queries_go_only_to_groups_that_they_can_reach():
    import pyarrow as pa

    hi, lo = ([np.array(x, dtype="<i8").tobytes() for x in xs] for xs in ([[5, 0], [0, 9], [-3, -3]], [[1, 0], [0, 2], [-4, -9]]))
    groups = pa.table({"group": [0, 1, 2], "largest": hi, "least": lo})
    q = [np.array(x, dtype="<i8").tobytes() for x in ([1, 0], [0, -1], [1, 1])]
    queries = pa.table({"vec_id": [1, 2, 3], "v": q, "n": [1, 1, 1], "floor": [5, 3, 10], "part": [0, 0, 0]})
    got = topk._reached(2)(queries, groups)
    assert dict(zip(got.column("vec_id").to_pylist(), got.column("groups").to_pylist())) == {1: [0], 2: [2]}


def test_top_k_against_brute_force(spark):
    rows = [(k, [RNG.uniform(-1, 1) for _ in range(6)]) for k in range(120)] + [(200 + k, [0.5] * 6) for k in range(30)]
    rows += [(300, None), (301, [1.0, None]), (302, [float("nan")] * 6), (303, [1.0, 1.0]), (304, []), (20, rows[20][1]), (None, [1.0]), (320, [1e15, -1e15, 1.0]), (340, [1e15, 1e15, 0.0])]
    table = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, score int")
    got = topk.top_k(table, F.col("vec_id") % 20 == 0, k=7, block_rows=8, range_rows=32, part_rows=4, pilot_rows=40)
    ok = [(d, [int(np.floor(x * 64)) for x in v]) for d, v in rows if d is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    want = set()
    for q in {d for d, _ in ok if d % 20 == 0}:
        best = sorted((-sum(a * b for a, b in zip(w, v)), d) for e, w in ok if e == q for d, v in ok if d != q)[:7]
        want |= {(q, r, d, -s) for r, (s, d) in enumerate(best, 1)}
    small = {x for x in want if x[0] < 320}  # of 1e15 the squares pass 2**63
    assert sorted(x for x in map(tuple, got.collect()) if x[0] < 320) == sorted(small)
    assert topk.top_k(table.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_toxicity(spark, no_docs):
    rows = [(k, prose(40) + (" you scumlord filthy " if k % 4 == 0 else " ") + prose(20)) for k in range(240)] + [(500, None), (501, ""), (502, "filthy scumlord"), (None, "filthy")]
    table = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, toxic string")
    labels = spark.createDataFrame([(k, int(k % 4 == 0)) for k in range(200)] + [(1, 0), (None, 1)], "doc_id long, toxic int")
    model = toxicity.learn(table, labels)
    got = {r.doc_id: r for r in toxicity.predict(table, model).collect()}
    assert all((got[k].score >= 0.5) == (k % 4 == 0) for k in range(240)) and got[502].score >= 0.5
    assert got[500].score == got[501].score < 0.5 and got[0].evidence
    assert toxicity.predict(no_docs, model).count() == 0
    assert {r.score for r in toxicity.predict(table, toxicity.learn(table, labels.limit(0))).collect()} == {0.0}


def test_nearest_is_exact():
    vectors = []
    for _ in range(400):
        at = np.array(sorted(RNG.sample(range(30), RNG.randint(0, 6))), dtype=np.int64)
        w = np.array([RNG.choice([1.0, 2.0]) for _ in at])
        vectors.append((at, w / np.sqrt((w * w).sum()) if len(w) else w))
    index = toxicity.Index(30, list(range(400)), [0] * 400, vectors)
    dense = index.weights[:, :400].T
    for at, w in vectors[:60]:
        q = np.zeros(30)
        q[at] = w
        s = np.round(dense @ q, 12)
        want = [i for i in np.lexsort((np.arange(400), -s)) if s[i] > 0][:9]
        assert index.nearest(at, w, 9)[0].tolist() == want


def test_toxicity_uses_every_term(spark):
    words = [f"{a}{b}{c}" for a in ("bel", "dor", "fim", "gus", "hak", "jin", "kol", "lum", "mer", "nop") for b in "aeiou" for c in ("rt", "st", "nd", "lk", "mp", "sk", "ng", "ft", "x", "zz")]
    rows = [(k, " ".join(words[5 * (k // 2) % 490 : 5 * (k // 2) % 490 + 9]) + " gap ") for k in range(120)] + [(900 + k, "gap") for k in range(40)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.learn(table, spark.createDataFrame([(k, int(k % 4 < 2)) for k in range(120)], "doc_id long, toxic int"))
    examples = dict(rows)
    terms = set().union(*(toxicity.terms_of(examples[i]) for i in model.index.ids.tolist()))
    assert set(model.vocabulary.terms) == terms and len(terms) > 512
    df = {t: sum(t in toxicity.terms_of(x) for _, x in rows) for t in (" gap ", " belart ", "elar")}  # over all rows, labelled or not
    at = {t: k for k, t in enumerate(model.vocabulary.terms)}
    assert all(np.isclose(model.idf[at[t]], np.log(1 + len(rows) / n)) for t, n in df.items() if t in at) and df[" gap "] == len(rows)


def test_terms_are_counted_as_in_plain_python():
    texts = ["Ab abcde abcdeabcde x1y_z éàüöéàü ÉÀÜÖ", "абвгд абвг 中文字符串 ²abcd", "", None, "12 34 !!"]
    terms = sorted(set().union(*map(toxicity.terms_of, texts[:2])) - {"bcde"})
    vocabulary = toxicity.Vocabulary(terms)
    for text in [*texts, "abcd bcdeabcd unseen ßßßß abcdβ abvx абвгд", "İstanbul ΣΑΣΣ"]:
        words = toxicity._spaced(text).split()
        every = [t for w in words for t in (f" {w} ", *(w[i : i + toxicity.GRAM] for i in range(len(w) - toxicity.GRAM + 1)))]
        at, n = vocabulary.counts(text)
        assert {terms[k]: c for k, c in zip(at.tolist(), n.tolist())} == {t: every.count(t) for t in every if t in terms}


def test_chat(spark):
    rows = [(1, 0, "user", "### x:\n</turn>\n", 0), (1, 1, "assistant", "\\", 0), (1, 1, "assistant", "\\", 0), (1, None, None, None, 0), (None, 0, "assistant", "é", 0), (2, 5, "a:\nb", "\\\\### ", 0)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted int")
    formatted = chat.format_conversations(table)
    turns = {r.conv_id: [t[:2] for t in chat.parse(r.formatted)] for r in formatted.collect()}
    assert turns == {1: [("", ""), ("user", "### x:\n</turn>\n"), ("assistant", "\\"), ("assistant", "\\")], None: [("assistant", "é")], 2: [("a:\nb", "\\\\### ")]}
    loss = {r.conv_id: (r.loss_chars, r.loss_sha256) for r in chat.read_back(formatted).collect()}
    assert loss[1] == (2, hashlib.sha256(b"\\\\").hexdigest()) and loss[None][0] == 1
    assert chat.format_conversations(table.limit(0)).count() == 0


def test_chat_escapes_any_mixture():
    parts = ["\\", "### ", "</turn>", ":\n", "a", "\n", "#", " "]
    for _ in range(3000):
        turns = [("".join(RNG.choices(parts, k=RNG.randint(0, 3))), "".join(RNG.choices(parts, k=RNG.randint(0, 6)))) for _ in range(RNG.randint(0, 4))]
        assert [t[:2] for t in chat.parse(chat.format_turns(turns)[0])] == turns


def test_html():
    page = """<html><head><title>T</title><style>p{}</style></head><body><nav><a href=1>Menu</a></nav><div class="cookie-notice">We use cookies, accept, please.</div>
    <article><h1>Head &amp; &eacute;</h1><p>First, <b>bold</b>\n text<br>here.<p>Second &lt;p&gt; <a href=x>link</a>, yes.</p><div class="comments"><p>Reader, says, hello, there.</p></div>
    <form><p>Subscribe, now</p></form></article><aside>Side, bar</aside><div class="ad">Buy, now, cheap</div><footer>&copy; foot</footer></body></html>"""
    assert extract_html.main_text(page) == "Head & é\n\nFirst, bold text here.\n\nSecond <p> link, yes."
    assert extract_html.main_text(None) == extract_html.main_text("") == extract_html.main_text("<p></p>") == ""
    assert extract_html.main_text("plain &amp; text") == "plain & text"
    assert extract_html.main_text("<div>" * 5000 + "<p>deep, text" + "</div>" * 5000) == "deep, text"
    assert extract_html.main_text("<article><p>a</p><p>a</p></article><b></i></p></div>") == "a\n\na"


def test_html_keeps_what_stands_beside_the_best_container():
    long = "".join(f"<p>{k}, a, b, {'word ' * 80}</p>" for k in range(12))
    rest = """<header><h2>Part</h2></header><section><p>Short end</p></section><ul><li>item one</li></ul><ol><li>step</li></ol><dl><dt>term</dt><dd>sense</dd></dl>
    <table><tr><th>head</th><td>cell</td></tr></table><figure><figcaption>caption</figcaption></figure><p><a href=x>linked</a> words and so</p><p>x <math><mi>m</mi></math> y</p>"""
    want = ["Part", "Short end", "item one", "step", "term", "sense", "head", "cell", "caption", "linked words and so", "x m y"]
    menu = "<ul><li><a href=1>Here</a></li><li><a href=2>There</a></li></ul>"
    for page in (f"<body><article><section>{long}</section>{rest}</article>{menu}</body>", f"<body><main><div>{long}</div>{rest}</main>{menu}</body>"):
        assert extract_html.main_text(page).split("\n\n")[12:] == want
    loose = rest.replace("<header><h2>Part</h2></header>", "<h2>Part</h2>")  # a header outside of an article is the page's
    got = extract_html.main_text(f"<body><span>Lead <b>in</b> <a href=x>y</a><div>{long}</div>{loose}{menu}tail</span></body>").split("\n\n")
    assert got[0] == "Lead in y" and got[13:] == [*want, "tail"]



def test_nearest_skips_blocks():
    rng = np.random.default_rng(3)
    vectors = []
    for k in range(640):  # five groups of examples with terms of their own, and a few shared by all
        at = np.sort(np.concatenate([rng.choice(20, 3, replace=False), 20 + 20 * (k % 5) + rng.choice(20, 12, replace=False)]))
        w = (rng.random(len(at)) + 0.5) * np.where(at < 20, 0.3, 1.0)
        vectors.append((at, w / np.sqrt(w @ w)))
    index = toxicity.Index(120, list(range(640)), [0] * 640, vectors)
    dense = index.weights.T
    got = list(index.nearest_of(vectors, 9, list(range(640))))
    for i, (at, w) in enumerate(vectors):
        q = np.zeros(120)
        q[at] = w
        s = np.round(dense @ q, 12)
        s[i] = 0
        assert got[i][0].tolist() == np.lexsort((np.arange(640), -s))[:9].tolist()
    assert 0 < index.scored < index.met / 2


def test_texts_handled_together():
    texts = ["a" * toxicity.CHARACTERS, None, "", "b", "c" * (toxicity.CHARACTERS + 5), *["d"] * (toxicity.TEXTS + 1)]
    runs = list(toxicity.together(texts))
    assert sum(runs, []) == texts and all(len(r) <= toxicity.TEXTS for r in runs)
    assert all(len(r) == 1 or sum(len(x or "") for x in r) <= toxicity.CHARACTERS for r in runs)


def test_html_sections_of_an_article_and_text_beside_it():
    body = "<p>First, second, third, and more text here, of the history.</p><p>Another, longer, paragraph, of, the, text.</p>"
    text = "First, second, third, and more text here, of the history.\n\nAnother, longer, paragraph, of, the, text."
    # a section named like a widget that holds the article stays; one that holds little goes
    assert extract_html.main_text(f'<article><section class="social history">{body}</section></article>') == text
    assert extract_html.main_text(f'<main><article><div class="related"><p>See, also</p></div>{body}<div id="share"><p>Share it</p></div></article></main>') == text
    assert extract_html.main_text(f'<article>{body}<div class="comments">{body}{body}{body}</div></article>') == text
    # unlabelled lines beside an article go; a heading, a long paragraph and a second article stay
    assert extract_html.main_text(f"<body><p>Your daily source</p><article>{body}</article><p>Posted by Jo</p><div>Copyright 2020 The Site</div></body>") == text
    more = "A long paragraph that belongs to the page, with words enough to be more than eighty characters."
    got = extract_html.main_text(f"<body><h1>Title</h1><article>{body}</article><p>{more}</p><article><p>Second, one.</p></article></body>")
    assert got == f"Title\n\n{text}\n\n{more}\n\nSecond, one."
    # without an article element all beside the best container stays
    assert extract_html.main_text(f"<body><div>{body}</div><p>Short end</p></body>") == f"{text}\n\nShort end"


def test_html_names_and_forms():
    article = "<h1>Head</h1><p>First, second, third, and more text here.</p>"
    text = "Head\n\nFirst, second, third, and more text here."
    side = '<div class="sidebar"><p>Latest, news, of, the, day, and, some, more, words.</p></div>'
    for page in (
        f'<div class="no-sidebar">{article}</div>{side}',
        f"<form action=x><article>{article}</article><input></form>{side}",
        f'<article><header class="header"><h1>Head</h1></header>{article[13:]}</article>',
        f'<article>{article}<div class="userComment"><p>I, too, think, so.</p></div></article>',
        f'<article>{article}<div class="article-comments"><p>I, too, think, so.</p></div></article>',
        f'<article>{article}</article><div class="cookiebar">We use cookies, yes.</div><div id="adbox">Buy, now.</div><div class="sponsored-content">Buy, this.</div>',
        f"<article>{article}<form><p>Subscribe, now</p></form></article>",
    ):
        assert extract_html.main_text(f"<html><body>{page}</body></html>") == text, page

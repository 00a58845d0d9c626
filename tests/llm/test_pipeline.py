"""The pipeline's stages on a small corpus, each against what a brute-force version keeps."""

import random

import corpus_pipeline as C
from surfrank.llm import neardup

RNG = random.Random(9)
WORDS = [f"{a}{b}" for a in ("ka", "lo", "mi", "ru", "te", "sa") for b in ("na", "so", "vi", "po", "da")]


def prose(n):
    return " ".join(RNG.choice(WORDS) for _ in range(n))


def test_stages(spark, tmp_path):
    item, passage, base = prose(25), prose(50), [prose(120) for _ in range(30)]
    texts = base + [base[0], base[1] + " end", prose(30) + " " + item + " " + prose(30), prose(40) + " " + passage + " " + prose(9), passage + " " + prose(60), None, "", "12 !!"]
    rows = [(k, t, "xx", "ab"[k % 2], len(t or ""), k) for k, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, copy_id int").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, kept = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    columns = docs.columns
    for name, stage in C.STAGES:
        docs = C.written(stage(spark, docs, str(tmp_path)), name)
        kept.append({r.doc_id: r for r in docs.collect()})
        assert name == "mixing" or docs.columns == columns
    language, near, cut, clean, mixed = kept
    assert set(language) == set(range(35))
    sets = {d: neardup.shingle_set(r.text, 5) for d, r in language.items()}
    alike = lambda a, b: 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    assert set(near) == {d for d in language if not any(e < d and alike(d, e) for e in language)}
    assert passage not in cut[33].text and passage not in cut[34].text and cut[33].n_chars == len(cut[33].text)
    assert all(cut[d].text == near[d].text for d in cut if d not in (33, 34))
    assert set(clean) == set(cut) - {32} and set(mixed) <= set(clean)
    total = sum(len(r.text.split()) for r in clean.values())
    assert abs(sum(r.n_words for r in docs.collect()) - 1.5 * total) <= 2

"""Language identification by rank-order profiles of n-grams.

A profile is a language's ``top`` most frequent n-grams of one to three
letters, in order of rank; words are lower-cased and padded with a boundary.
A document's own most frequent n-grams are ranked alike, and its distance to a
language is the sum over them of how far each is out of place there (``top``
for one that the profile hasn't got).  The nearest language is predicted;
the score is 1 - distance / largest possible distance.

Profiles are learned from a bounded sample of the labelled rows (about
``sample_docs`` texts of each language, chosen by a hash of the id); the number of
rows of each language is counted over all.  Every text is scored over its whole
length, in slices that end between words, so memory doesn't grow with a text.

A null text, or one without a letter, is ``und`` with score 0, and so is every
text if no language can be learned.  Ties go to the rarer n-gram code when
ranking and to the first language by code point.  Repeated rows get the same
prediction; extra columns are dropped; no rows give no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from surfrank.llm.tables import table

TOP = 400
SAMPLE_DOCS = 1500
SLICE_CHARS = 1 << 20
EDGE = 1  # the code of a word's boundary; no letter has it
UND = "und"
#: Scores below say that the text is in none of the learned languages; texts in one of them score 0.4 to 0.9.
MIN_SCORE = 0.15
_LETTER: list[np.ndarray] = []


def _is_letter() -> np.ndarray:
    if not _LETTER:
        _LETTER.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000))
    return _LETTER[0]


def _gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(codes, counts) of the n-grams; a code has 21 bits for each letter."""
    cps = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    letter = _is_letter()[cps]
    found, n = [], np.zeros(0, dtype=np.int64)
    at = 0
    while at < len(cps):
        end = min(len(cps), at + SLICE_CHARS)
        while end < len(cps) and letter[end] and letter[end - 1]:
            end += 1
        here = letter[at:end]
        keep = here.copy()
        keep[1:] |= here[:-1]  # the first character after a word is its boundary
        a = np.empty(int(keep.sum()) + 2, dtype=np.int64)
        a[0] = a[-1] = EDGE
        a[1:-1] = np.where(here[keep], cps[at:end][keep], EDGE)
        x, y, z = a[:-2], a[1:-1], a[2:]
        one, two, three = a[a != EDGE], a[:-1] << 21 | a[1:], x << 42 | y << 21 | z
        grams = np.concatenate([one, two[(a[:-1] != EDGE) | (a[1:] != EDGE)], three[y != EDGE]])
        found.append(np.unique(grams, return_counts=True))
        at = end
    if not found:
        return n, n
    if len(found) == 1:
        return found[0]
    codes, back = np.unique(np.concatenate([f[0] for f in found]), return_inverse=True)
    return codes, np.bincount(back, weights=np.concatenate([f[1] for f in found])).astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sums: dict[str, Counter] = {}
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            codes, counts = _gram_counts(text)
            sums.setdefault(lang, Counter()).update(dict(zip(codes.tolist(), counts.tolist())))
        rows = [(lang, code, n) for lang, c in sums.items() for code, n in c.items()]
        lang, code, n = zip(*rows) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(code, pa.int64()), pa.array(n, pa.int64())], names=["lang", "code", "n"])


def learn(labelled: DataFrame, top: int = TOP, sample_docs: int = SAMPLE_DOCS) -> dict[str, list[int]]:
    """lang -> its n-gram codes by rank, from rows (doc_id, text, lang) of a bounded sample."""
    rows = labelled.where("text IS NOT NULL AND lang IS NOT NULL").select("doc_id", "text", "lang")
    per = rows.groupBy("lang").agg(F.count("*").alias("n"))
    u = F.pmod(F.xxhash64(F.lit(3), "doc_id"), F.lit(1 << 30)) / float(1 << 30)
    langs = {r["lang"]: r["n"] for r in per.collect()}  # bounded by the number of languages
    if not langs:
        return {}
    chosen = F.lit(False)
    for lang, n in langs.items():
        chosen = chosen | ((F.col("lang") == lang) & (u < min(1.0, sample_docs / n)))
    grams = rows.where(chosen).select("lang", "text").mapInArrow(_count, "lang string, code long, n long")
    grams = grams.groupBy("lang", "code").agg(F.sum("n").alias("n"))
    # the sample is bounded, so a language's distinct n-grams are too
    best = grams.groupBy("lang").agg(F.slice(F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("m"), "code"))), 1, top)["code"].alias("codes"))
    return {r["lang"]: list(r["codes"]) for r in best.collect()}  # bounded by top and the number of languages


class Profiles:
    """Ranks of all profiles' n-grams, for distances to every language at once."""

    def __init__(self, ranked: dict[str, list[int]], top: int):
        self.top, self.langs = top, sorted(x for x in ranked if ranked[x])
        self.codes = np.unique(np.array([c for x in self.langs for c in ranked[x]], dtype=np.int64))
        self.ranks = np.full((len(self.codes) + 1, len(self.langs)), -1, dtype=np.int64)
        for k, lang in enumerate(self.langs):
            self.ranks[np.searchsorted(self.codes, ranked[lang]), k] = np.arange(len(ranked[lang]))

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.langs:
            return UND, 0.0
        codes, counts = _gram_counts(text)
        if len(codes) == 0:
            return UND, 0.0
        order = np.argsort(-counts, kind="stable")[: self.top]
        mine = codes[order]
        at = np.searchsorted(self.codes, mine)
        at[at == len(self.codes)] = 0
        at = np.where(self.codes[at] == mine, at, len(self.codes))
        ranks = self.ranks[at]
        away = np.abs(ranks - np.arange(len(mine))[:, None])
        distance = np.where(ranks < 0, self.top, away).sum(axis=0)
        best = int(np.argmin(distance))
        return self.langs[best], float(1 - distance[best] / (self.top * len(mine)))


def predict(documents: DataFrame, profiles: dict[str, list[int]], top: int = TOP, keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default doc_id) of each row with lang_pred and score; only text is looked at."""
    keep = keep or ["doc_id"]
    names = [f"c{k}" for k in range(len(keep))]  # so that no column clashes with the operator's own
    rows = documents.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(keep, names)], *([] if "text" in keep else [F.col("text").alias("text")]))
    text = names[keep.index("text")] if "text" in keep else "text"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Profiles(profiles, top)
        for batch in batches:
            langs, scores = zip(*(model.predict(x) for x in batch.column(text).to_pylist())) if batch.num_rows else ((), ())
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=[*names, "lang_pred", "score"])

    schema = T.StructType([T.StructField(n, rows.schema[n].dataType) for n in names]).add("lang_pred", T.StringType()).add("score", T.DoubleType())
    return rows.mapInArrow(run, schema).select("lang_pred", "score", *[F.col(n).alias(c) for c, n in zip(keep, names)])


def held_out() -> F.Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2


def identify(documents: DataFrame, top: int = TOP, sample_docs: int = SAMPLE_DOCS, keep: list[str] | None = None) -> DataFrame:
    """Learn from the rows that aren't held out, predict all rows."""
    return predict(documents, learn(documents.where(~held_out()), top, sample_docs), top, keep)


def recognised(documents: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """The rows, with all their columns, whose text is in a learned language: not ``und``, and no farther than min_score says."""
    columns = documents.columns
    scored = identify(documents, keep=columns).toDF("lang_pred", "score", *[f"c{k}" for k in range(len(columns))])
    return scored.where((F.col("lang_pred") != UND) & (F.col("score") >= min_score)).drop("lang_pred", "score").toDF(*columns)


def op3_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumn("doc_id", F.col("doc_id").cast("long"))
    return identify(docs).select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score")

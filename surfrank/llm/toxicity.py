"""Toxicity by the nearest labelled examples under exact TF-IDF cosine.

Examples are a bounded sample of the labelled rows (about ``sample_rows`` of each
class, chosen by a hash of the id; counts of the classes are over all labelled
rows).  Terms are words and runs of four letters within words, lower-cased;
the vocabulary is every term that an example has (a term of no example is no
part of the space).  The document frequency of each is counted over all
documents.  A text's vector has (1 + ln tf) * ln(1 + documents / frequency) for
each term, scaled to length 1.

The examples form an inverted index in blocks of ``BLOCK``, alike ones and ones of
like length side by side.  Rare terms have postings (their examples and weights).  For terms
that many examples have, a block holds their weights in single precision and each
one's largest weight.  A text's rare terms are scored first; a block's bound is its best score so far plus
the text's weights times the block's largest ones.  Blocks are
scored from the highest bound on, for a few texts at once, and those whose bound
falls below the k-th cosine are skipped.  Every example within a margin of the k-th
cosine, wider than the error of these sums, is then scored again in double precision, so
the ``k`` nearest are exact.  They vote with 1 / (0.05 + distance),
weighed so that classes count as often as among all labelled rows; a monotone
calibration, fitted on the examples' votes without themselves, makes
a score of the vote.  Texts that share no term with any example, empty and
null ones among them, get the calibrated share of toxic ones among such examples.

The nearest examples are returned as evidence.  Ties go to the smaller example doc_id.  A row
labelled twice is toxic if any label says so.  Without labels of both
classes every score is the share of toxic rows (0 if there are none).  Repeated rows get
equal scores; extra columns are dropped; whole texts are read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surfrank.llm.tables import table, written
from surfrank.llm.text import mix, run_sums

SAMPLE_ROWS = 2048
#: Of 5 to 100, the best in cross-validation on the rows of sf0.1 that may be learned from (68 of 100 toxic ones at 5 false alarms in 1000).
NEIGHBOURS = 30
GRAM = 4
#: Terms that more than one of so many examples have are rows of the matrix.
DENSE = 16
#: Examples of a block; blocks that a text meets before its k-th cosine is looked at again.
BLOCK = 64
ROUNDS = (3, 10)
#: Groups of alike examples that the blocks are cut from.
GROUPS = 16
#: Texts, and characters of texts beyond the first, that are handled together.
TEXTS = 64
CHARACTERS = 1 << 18
_BREAK = re.compile(r"[\W\d_]+")


def _spaced(text: str | None) -> str:
    return f" {_BREAK.sub(' ', (text or '').lower())} "


def terms_of(text: str | None) -> set[str]:
    """Words (between spaces) and runs of letters of a text."""
    words = set(_spaced(text).split())
    return {f" {w} " for w in words} | {w[i : i + GRAM] for w in words for i in range(len(w) - GRAM + 1)}


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        terms = sorted(set().union(*map(terms_of, batch.column("text").to_pylist())))
        yield pa.RecordBatch.from_arrays([pa.array(terms, pa.string())], names=["term"])


def _letters() -> np.ndarray:
    """By code point, whether it is part of a word."""
    out = np.ones(0x110000, dtype=bool)
    for m in _BREAK.finditer("".join(map(chr, range(0x110000)))):
        out[m.start() : m.end()] = False
    return out


class Numbers:
    """An open hash table from nonzero 64-bit keys to numbers, looked up for whole arrays."""

    def __init__(self, keys: np.ndarray, numbers: np.ndarray):
        self.bits = max(10, int(4 * len(keys)).bit_length())
        self.slots, self.found = np.zeros(1 << self.bits, dtype=np.uint64), np.full(1 << self.bits, -1, dtype=np.int64)
        left, at = np.arange(len(keys)), self._slot(keys)
        while len(left):  # each round, one key takes a free slot and the others go on to the next
            free = left[self.slots[at[left]] == 0]
            self.slots[at[free]] = keys[free]
            self.found[at[free]] = numbers[free]
            left = left[self.slots[at[left]] != keys[left]]
            at[left] = (at[left] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places, numbers) of the keys that the table has."""
        left, at, out = keys, self._slot(keys), [(places[:0], places[:0])]
        while len(left):
            there = self.slots[at]
            same = there == left
            out.append((places[same], self.found[at[same]]))
            on = np.flatnonzero(~same & (there != 0))
            left, at, places = left[on], (at[on] + 1) & ((1 << self.bits) - 1), places[on]
        return np.concatenate([x for x, _ in out]), np.concatenate([x for _, x in out])


class Vocabulary:
    """Numbers and counts of the known terms in a text.

    Terms are looked up as arrays.  Each letter that the terms have gets a number
    below 2**16, so a run of four is a whole key; a word's key is a 64-bit hash of its letters.
    """

    def __init__(self, terms: list[str]):
        self.terms = terms
        self.letters: np.ndarray | None = None  # made where it is first needed

    def __reduce__(self):
        return Vocabulary, (self.terms,)

    def _arrange(self) -> None:
        self.letters = _letters()
        self.value = mix(np.arange(1, 0x110001, dtype=np.uint64))
        runs = [(t, k) for k, t in enumerate(self.terms) if t[0] != " "]
        words = [(t, k) for k, t in enumerate(self.terms) if t[0] == " "]
        points = np.frombuffer("".join(t for t, _ in runs).encode("utf-32-le", "surrogatepass"), dtype="<u4")
        used = np.unique(points)
        if len(used) >= 1 << 16:
            raise ValueError("more than 65535 letters in the examples' terms")
        self.code = np.zeros(0x110000, dtype=np.uint64)  # 0: in no term
        self.code[used] = np.arange(1, len(used) + 1)
        keys = self._keys(self.code[points])[::GRAM] if runs else np.zeros(0, dtype=np.uint64)
        self.runs = Numbers(keys, np.array([k for _, k in runs], dtype=np.int64))
        points = np.frombuffer("".join(t for t, _ in words).encode("utf-32-le", "surrogatepass"), dtype="<u4")
        self.words = Numbers(self._words(points, points != 32)[0], np.array([k for _, k in words], dtype=np.int64))

    @staticmethod
    def _keys(code: np.ndarray) -> np.ndarray:
        out = code[: len(code) - GRAM + 1].copy()
        for k in range(1, GRAM):
            out = out << np.uint64(16) | code[k : len(code) - GRAM + 1 + k]
        return out

    def _words(self, points: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(keys, places) of the words, the runs of points ``inside``."""
        edge = np.flatnonzero(np.diff(inside, prepend=False, append=False))
        first, end = edge[::2], edge[1::2]
        keys = mix(run_sums(self.value[points], first, end) + (end - first).astype(np.uint64))
        return np.where(keys == 0, np.uint64(1), keys), first

    def found_in(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, term number, count) of the known terms of some texts, in order of both."""
        if self.letters is None:
            self._arrange()
        lower = [(x or "").lower() for x in texts]
        points = np.frombuffer((" ".join(lower) + " ").encode("utf-32-le", "surrogatepass"), dtype="<u4")
        word_places, words = self.words.find(*self._words(points, self.letters[points]))
        code = self.code[points]
        whole = code != 0  # false between words and for letters in no term
        starts = np.flatnonzero(whole[:-3] & whole[1:-2] & whole[2:-1] & whole[3:]) if len(points) >= GRAM else np.zeros(0, dtype=np.int64)
        run_places, runs = self.runs.find(self._keys(code)[starts] if len(starts) else np.zeros(0, dtype=np.uint64), starts)
        text = np.repeat(np.arange(len(texts)), [len(x) + 1 for x in lower])[np.concatenate([word_places, run_places])]
        keys = np.sort(text << 32 | np.concatenate([words, runs]))
        first = np.flatnonzero(np.diff(keys, prepend=-1))
        return keys[first] >> 32, keys[first] & 0xFFFFFFFF, np.diff(first, append=len(keys)).astype(np.float64)

    def counts(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """(term numbers, counts), in order of the numbers."""
        return self.found_in([text])[1:]

    def vectors(self, texts: list[str | None], idf: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(term numbers, weights) of length 1 of each text; empty if it has none of the terms."""
        for some in together(texts):
            text, at, counts = self.found_in(some)
            w = (1 + np.log(counts)) * idf[at]
            ends = np.searchsorted(text, np.arange(len(some) + 1))
            for a, b in zip(ends[:-1].tolist(), ends[1:].tolist()):
                yield at[a:b], w[a:b] / (math.sqrt(float(w[a:b] @ w[a:b])) if b > a else 1.0)


def together(texts: list[str | None]) -> Iterator[list[str | None]]:
    """The texts in runs of at most TEXTS, and CHARACTERS unless a run is one text."""
    run: list[str | None] = []
    size = 0
    for x in texts:
        n = len(x or "")
        if run and (len(run) == TEXTS or size + n > CHARACTERS):
            yield run
            run, size = [], 0
        run.append(x)
        size += n
    if run:
        yield run


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers from each start on, one range after the other."""
    return np.arange(size.sum()) + np.repeat(start - np.cumsum(size) + size, size)


def _groups(rows: np.ndarray) -> np.ndarray:
    """A group of alike examples for each row: the nearest of a few means, in a few turns."""
    means = rows[np.linspace(0, len(rows) - 1, min(GROUPS, len(rows))).astype(np.int64)]
    group = np.zeros(len(rows), dtype=np.int64)
    for _ in range(4 if len(rows) else 0):
        group = (rows @ means.T).argmax(axis=1)
        means = np.stack([rows[group == g].sum(axis=0) if (group == g).any() else means[g] for g in range(len(means))])
        means /= np.maximum(np.linalg.norm(means, axis=1, keepdims=True), 1e-9)
    return group


class Index:
    """The examples' vectors, and an inverted index of them in blocks with the largest weights."""

    def __init__(self, n_terms: int, ids: list[int], labels: list[int], vectors: list[tuple[np.ndarray, np.ndarray]]):
        self.n_terms, self.ids, self.labels = n_terms, np.array(ids, dtype=np.int64), np.array(labels, dtype=np.int64)
        self.size = np.array([len(at) for at, _ in vectors], dtype=np.int64)
        self.at = np.concatenate([np.zeros(0, dtype=np.int32), *(at.astype(np.int32, copy=False) for at, _ in vectors)])
        self.w = np.concatenate([np.zeros(0), *(w for _, w in vectors)])
        self.blocks: np.ndarray | None = None  # made where it is first needed
        self.scored, self.met = 0, 0  # pairs of a text and a block: scored, and all

    def _arrange(self) -> None:
        n = len(self.ids)
        self.start = np.cumsum(self.size) - self.size
        who = np.repeat(np.arange(n, dtype=np.int32), self.size)
        self.had = np.bincount(self.at, minlength=self.n_terms)
        common = np.flatnonzero(self.had * DENSE > n)
        self.row = np.full(self.n_terms, -1, dtype=np.int64)
        self.row[common] = np.arange(len(common))
        self.query = np.zeros(len(common))
        dense = self.row[self.at] >= 0
        # the examples' common terms once more, in double precision, by row; the postings have the rare ones
        self.common_size = np.bincount(who[dense], minlength=n)
        self.common_start = np.cumsum(self.common_size) - self.common_size
        self.common_row, self.common_w = self.row[self.at[dense]], self.w[dense]
        rows = np.zeros((n, len(common)), dtype=np.float32)
        rows[who[dense], self.row[self.at[dense]]] = self.w[dense]
        # the example at each place of the blocks; -1 after the last
        n_blocks = -(-n // BLOCK)
        self.example = np.full(n_blocks * BLOCK, -1, dtype=np.int64)
        self.example[:n] = np.lexsort((self.size, _groups(rows)))
        self.place = np.zeros(n, dtype=np.int64)
        self.place[self.example[:n]] = np.arange(n)
        padded = np.concatenate([rows[self.example[:n]], np.zeros((len(self.example) - n, len(common)), dtype=np.float32)])
        self.blocks = np.ascontiguousarray(padded.reshape(n_blocks, BLOCK, len(common)).transpose(0, 2, 1))
        self.largest = np.ascontiguousarray(self.blocks.max(axis=2, initial=0.0).T)
        rare = np.flatnonzero(~dense)
        rare = rare[np.argsort(self.at[rare], kind="stable")]
        self.had[common] = 0
        self.first = np.cumsum(self.had) - self.had
        self.posted, self.posted_w = self.place[who[rare]].astype(np.int32), self.w[rare]

    def __getstate__(self):
        return {k: getattr(self, k) for k in ("n_terms", "ids", "labels", "size", "at", "w")}

    def __setstate__(self, state):
        self.__dict__.update(state, blocks=None, scored=0, met=0)

    @property
    def weights(self) -> np.ndarray:
        """All weights, term by example; for small indexes."""
        out = np.zeros((self.n_terms, len(self.ids)))
        out[self.at, np.repeat(np.arange(len(self.ids)), self.size)] = self.w
        return out

    def nearest(self, at: np.ndarray, w: np.ndarray, k: int, without: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """(examples, cosines) of the k highest cosines above 0, ties to the smaller example."""
        return next(self.nearest_of([(at, w)], k, [without]))

    def nearest_of(self, vectors: list[tuple[np.ndarray, np.ndarray]], k: int, without: list[int] | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        if self.blocks is None:
            self._arrange()
        for b in range(0, len(vectors), TEXTS):
            some = vectors[b : b + TEXTS]
            near = self._near(some, k, without[b : b + TEXTS] if without else [-1] * len(some))
            for (at, w), (who, rare) in zip(some, near):
                yield self._best(at, w, who, rare, k)

    def _near(self, some: list[tuple[np.ndarray, np.ndarray]], k: int, without: list[int]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each text the examples that may be among its k best, found block by block, and what its rare terms add to their cosines."""
        n_blocks, n_common, _ = self.blocks.shape
        q = np.zeros((len(some), n_common), dtype=np.float32)
        s = np.zeros((len(some), n_blocks * BLOCK))
        for i, (at, w) in enumerate(some):
            row = self.row[at]
            q[i, row[row >= 0]] = w[row >= 0]
            had = self.had[at]
            posts = _ranges(self.first[at], had)
            s[i] = np.bincount(self.posted[posts], weights=self.posted_w[posts] * np.repeat(w, had), minlength=s.shape[1])
            if without[i] >= 0:
                s[i, self.place[without[i]]] = -np.inf
        s[:, self.example < 0] = -np.inf
        s = s.reshape(len(some), n_blocks, BLOCK)
        bounds = s.max(axis=2, initial=-np.inf) + q @ self.largest
        margin = (n_common + 4) * 2.0**-22  # twice the error of two such sums
        floor, seen, most = np.zeros(len(some)), np.full(s.shape, -np.inf), s.shape[1] * BLOCK
        for n in (*ROUNDS, n_blocks):
            going = (bounds > 0) & (bounds >= floor[:, None] - margin)
            if n < n_blocks:
                going &= bounds >= -np.partition(-bounds, n - 1, axis=1)[:, n - 1 : n]
            for block in np.flatnonzero(going.any(axis=0)):
                who = np.flatnonzero(going[:, block])
                seen[who, block] = s[who, block] + q[who] @ self.blocks[block]
            bounds[going] = -np.inf
            self.scored += int(going.sum())
            if most > k:
                floor = np.maximum(0.0, np.partition(seen.reshape(len(some), most), most - k, axis=1)[:, most - k])
        self.met += bounds.size
        out = (seen > 0) & (seen >= floor[:, None, None] - margin)
        found = [np.sort(self.example[x]) for x in out.reshape(len(some), most)]
        return [(who, rare[self.place[who]]) for who, rare in zip(found, s.reshape(len(some), most))]

    def _best(self, at: np.ndarray, w: np.ndarray, who: np.ndarray, rare: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k best of some examples that share a term with the text; ``rare``: what its rare terms add to their cosines."""
        if len(who) == 0:
            return np.zeros(0, dtype=np.int64), np.zeros(0)
        row = self.row[at]
        row, w = row[row >= 0], w[row >= 0]
        self.query[row] = w
        spans = zip(self.common_start[who].tolist(), (self.common_start[who] + self.common_size[who]).tolist())
        s = np.round(rare + [self.query.take(self.common_row[a:b]) @ self.common_w[a:b] for a, b in spans], 12)
        self.query[row] = 0.0
        best = np.lexsort((who, -s))[:k]
        return who[best], s[best]

    def vote(self, who: np.ndarray, s: np.ndarray, shares: np.ndarray) -> float:
        """The weighed share of toxic neighbours; -1 without neighbours."""
        if len(who) == 0:
            return -1.0
        w = shares[self.labels[who]] / (1.05 - s)
        return float(w[self.labels[who] == 1].sum() / w.sum())


def isotonic(votes: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the nondecreasing function that fits labels by weighted squares (pool adjacent violators)."""
    votes, back = np.unique(votes, return_inverse=True)
    w = np.bincount(back, weights=weights)
    y = np.bincount(back, weights=weights * labels) / w
    pools: list[list[float]] = []
    for k in range(len(votes)):
        pools.append([y[k], w[k], k, k])
        while len(pools) > 1 and pools[-2][0] >= pools[-1][0]:
            b, a = pools.pop(), pools.pop()
            pools.append([(a[0] * a[1] + b[0] * b[1]) / (a[1] + b[1]), a[1] + b[1], a[2], b[3]])
    x = [votes[int(p[j])] for p in pools for j in (2, 3)]
    return np.array(x), np.array([p[0] for p in pools for _ in (2, 3)])


class Model:
    """What scoring needs; its size is bounded by the sample's texts."""

    def __init__(self, context, vocabulary: Vocabulary, idf: np.ndarray, index: Index, shares: np.ndarray, k: int):
        self.vocabulary, self.idf, self.index, self.shares, self.k = vocabulary, idf, index, shares, k
        self.known = context.broadcast((vocabulary, idf, index))
        self.x, self.y, self.none = np.zeros(0), np.zeros(0), 0.0

    def scorer(self):
        """The score of a vote; it holds the calibration only."""
        x, y, none = self.x, self.y, self.none
        return lambda vote: none if vote < 0 or len(x) == 0 else float(np.interp(vote, x, y))


def labelled_rows(labels: DataFrame) -> DataFrame:
    """(doc_id, toxic) of the rows that may be learned from."""
    rows = labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    return rows.where(~held_out())


def held_out() -> F.Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0


def _vectors(known, idf):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = list(known.value.vectors(batch.column("text").to_pylist(), idf.value))
            parts = [pa.array([x.astype(kind).tobytes() for x in column], pa.binary()) for column, kind in ((([g[0] for g in got]), "<i4"), (([g[1] for g in got]), "<f8"))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("toxic"), *parts], names=["doc_id", "toxic", "at", "w"])

    return run


def _frequencies(known):
    """A row for each known term in a partition, with the number of its texts; term -1 has the number of all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, np.zeros(len(known.value.terms), dtype=np.int64)
        for batch in batches:
            n += batch.num_rows
            for some in together(batch.column("text").to_pylist()):
                sums += np.bincount(known.value.found_in(some)[1], minlength=len(sums))
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(sums[at], n))], names=["term", "n"])

    return run


def _votes(known, shares: np.ndarray, k: int):
    """The vote of each example without itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index: Index = known.value[2]
        start = np.cumsum(index.size) - index.size
        for batch in batches:
            which = np.searchsorted(index.ids, batch.column("doc_id").to_numpy()).tolist()
            vectors = [(index.at[start[i] : start[i] + index.size[i]], index.w[start[i] : start[i] + index.size[i]]) for i in which]
            votes = [index.vote(who, s, shares) for who, s in index.nearest_of(vectors, k, which)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(votes, pa.float64())], names=["doc_id", "vote"])

    return run


def learn(documents: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, k: int = NEIGHBOURS) -> Model:
    rows = labelled_rows(labels)
    n = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}  # bounded by two classes
    total = sum(n.values())
    if len(n) < 2:
        model = Model(documents.sparkSession.sparkContext, Vocabulary([]), np.zeros(0), Index(0, [], [], []), np.ones(2), k)
        model.none = n.get(1, 0) / total if total else 0.0
        return model
    u = F.pmod(F.xxhash64(F.lit(7), "doc_id"), F.lit(1 << 30)) / float(1 << 30)
    share = F.when(F.col("toxic") == 1, min(1.0, sample_rows / n[1])).otherwise(min(1.0, sample_rows / n[0]))
    chosen = F.broadcast(rows.where(u < share).limit(4 * sample_rows))  # bounded by sample_rows
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sample = written(texts.join(chosen, "doc_id").dropDuplicates(["doc_id"]), "examples")
    size = {0: 0, 1: 0} | {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}  # bounded by two classes
    shares = np.array([n[c] / max(size[c], 1) for c in (0, 1)])

    terms = sorted(sample.select("text").mapInArrow(_terms, "term string").distinct().toArrow().column("term").to_pylist())  # bounded by the sample's texts
    vocabulary, context = Vocabulary(terms), documents.sparkSession.sparkContext
    known = context.broadcast(vocabulary)
    found = texts.select("text").mapInArrow(_frequencies(known), "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    found = found.toArrow()  # bounded by the sample's terms
    n_of = np.ones(len(terms) + 1)  # the last, at -1, has the number of all texts
    n_of[found.column("term").to_numpy()] = found.column("n").to_numpy()
    idf = np.log1p(n_of[-1] / n_of[:-1])

    examples = sample.mapInArrow(_vectors(known, context.broadcast(idf)), "doc_id long, toxic int, at binary, w binary").toArrow().sort_by("doc_id")  # bounded by the sample's texts
    vectors = [(np.frombuffer(at.as_py(), dtype="<i4"), np.frombuffer(w.as_py(), dtype="<f8")) for at, w in zip(examples.column("at"), examples.column("w"))]
    index = Index(len(terms), examples.column("doc_id").to_pylist(), examples.column("toxic").to_pylist(), vectors)
    del examples, vectors, found, n_of
    model = Model(context, vocabulary, idf, index, shares, k)
    voted = sample.select("doc_id").mapInArrow(_votes(model.known, shares, k), "doc_id long, vote double").toArrow().sort_by("doc_id")  # bounded by sample_rows
    votes = voted.column("vote").to_numpy()
    weight = shares[index.labels] if len(index.ids) else np.zeros(0)
    some = votes >= 0
    if some.any():
        model.x, model.y = isotonic(votes[some], index.labels[some].astype(float), weight[some])
    toxic, none = weight[~some][index.labels[~some] == 1].sum(), weight[~some].sum()
    model.none = float((toxic + n[1] / total) / (none + 1))
    return model


EVIDENCE = pa.struct([("doc_id", pa.int64()), ("toxic", pa.int32()), ("cosine", pa.float64())])


def _evidence(index: Index, near: list[tuple[np.ndarray, np.ndarray]]) -> pa.ListArray:
    """The examples and cosines that were found for each text of a batch."""
    offsets = np.cumsum([0, *(len(who) for who, _ in near)]).astype(np.int32)
    who = np.concatenate([np.zeros(0, dtype=np.int64), *(who for who, _ in near)])
    cosine = np.concatenate([np.zeros(0), *(s for _, s in near)])
    columns = [pa.array(index.ids[who]), pa.array(index.labels[who].astype(np.int32)), pa.array(cosine)]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(columns, fields=list(EVIDENCE)))


def predict(documents: DataFrame, model: Model) -> DataFrame:
    """doc_id, score and evidence (the nearest examples) of each row; only text is looked at."""
    known, shares, k, score = model.known, model.shares, model.k, model.scorer()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, idf, index = known.value
        for batch in batches:
            texts, near = batch.column("text").to_pylist(), []
            for a in range(0, len(texts), TEXTS):  # a batch's vectors at once would be over 100 MB
                near += index.nearest_of(list(vocabulary.vectors(texts[a : a + TEXTS], idf)), k)
            scores = [score(index.vote(who, s, shares)) for who, s in near]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64()), _evidence(index, near)], names=["doc_id", "score", "evidence"])

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double, evidence array<struct<doc_id:long,toxic:int,cosine:double>>")


def op6_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    out = predict(docs, learn(docs, table(spark, sf_dir, "labels")))
    return out.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))

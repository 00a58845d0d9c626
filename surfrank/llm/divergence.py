"""Divergence of the sources of each language, priced from one-hot level products.

Terms are runs of letters of ASCII and of any other characters above it, A-Z folded.
A language keeps the V terms that come in ``min_docs`` or more of its documents.  A
group is a (lang, source) that occurs, with or without terms.  With count
occurrences of a kept term and N of all of them, a group (or the language) gives it

    p = 1 + floor(10**9 * (count + 2) / (N + 2 * V)),

and the divergence of two values is f(p, q) = floor((p - q)**2 / (p + q)).  Part
``pair`` has, for each group and each other source of its language, the sum of f over all
kept terms; part ``term`` the terms of a group that it has more than its language, by
f, the first ``top``.

The pairs come from joint tables of levels.  A block of terms makes a 0/1 matrix with a
column for each (group, level of count) in it, zero being a level; the product of its
transpose with itself has, for any two groups and levels, the number of
terms at both.  These counts are priced by f and summed over blocks.  The
counts are small integers, so the products in single precision are exact, and prices
are 64-bit integers.  Prices are taken relative to that of two zeros, so a block
need not hold the terms that neither group has; V times that price is added at the end.

Blocks are (lang, band, part, block of groups, block of groups): a band holds
terms of like frequency, so a block has few levels, a part up to about ``TERM_BLOCK`` terms,
and a block of groups about ``GROUP_BLOCK`` sources.  No task holds a language.

Counts are added up in the tasks that read documents (up to ``HELD_TERMS`` entries at
once) before they are shuffled, so very frequent words and a source of a third of
all rows are a few rows of each task.

Null text, lang and source are read as ''.  Repeated rows and null or repeated doc_ids are
documents like any other.  Languages without kept terms have V = 0: their pairs
are 0 and they have no terms.  Ties in value go to the smaller item in UTF-8.  An
empty table gives no rows.  Extra columns are dropped.  A long text is read in slices.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from surfrank.llm.tables import broadcast_if_small, table, written

MIN_DOCS, TOP = 10, 10
#: Terms and groups of a block, and entries that a counting task holds before it passes them on.
TERM_BLOCK, GROUP_BLOCK, HELD_TERMS = 2048, 32, 500_000
#: A document in a count that also holds the occurrences, and the documents held at once: both fit into 64 bits.
DOC, HELD_DOCS = 1 << 40, 1 << 22
#: The band of the cells that hold no terms: they add V times the price of two zeros.
BASE = -1
#: Columns of a product's operands; a group's own levels stay together.
COLUMN_BLOCK = 512
SLICE_BYTES = 1 << 20
#: Each letter, folded, and each byte above ASCII; the others separate terms.
_TERM_BYTES = bytes(c if c >= 0x80 or 0x61 <= c <= 0x7A else c + 32 if 0x41 <= c <= 0x5A else 0x20 for c in range(256))


def term_counts(text: bytes) -> Counter:
    """Occurrences of each term of a UTF-8 text."""
    if len(text) <= SLICE_BYTES:
        return Counter(text.translate(_TERM_BYTES).split())
    out: Counter = Counter()
    at = 0
    while at < len(text):
        end = at + SLICE_BYTES
        while end < len(text) and _TERM_BYTES[text[end]] != 0x20:
            end += 1
        out.update(text[at:end].translate(_TERM_BYTES).split())
        at = end
    return out


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, n, docs) of many documents at once; a group's row without a term says that it occurs."""
    names = ["lang", "source", "term", "n", "docs"]
    groups: dict[tuple, dict[bytes, int]] = {}  # occurrences + DOC * documents

    def out():
        for (lang, source), counts in groups.items():
            terms, both = [None, *counts], np.array([0, *counts.values()], dtype=np.int64)
            for i in range(0, len(terms), 1 << 16):
                term, n = pa.array(terms[i : i + (1 << 16)], pa.binary()).cast(pa.string()), both[i : i + (1 << 16)]
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(n), pa.string()), pa.array([source] * len(n), pa.string()), term, pa.array(n % DOC), pa.array(n // DOC)], names=names)
        groups.clear()

    held = read = 0
    for batch in batches:
        for lang, source, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "source", "text"))):
            counts = groups.setdefault((lang, source), {})
            get, held = counts.get, held - len(counts)
            for term, n in term_counts(text).items():
                counts[term] = get(term, 0) + n + DOC
            held, read = held + len(counts), read + 1
            if held >= HELD_TERMS or read >= HELD_DOCS:
                yield from out()
                held = read = 0
    yield from out()


def _p(count: str, n: str) -> F.Column:
    """1 + floor(10**9 * (count + 2) / (n + 2 * v)), exact beyond 64 bits; null if nothing is kept."""
    return F.expr(f"1 + (CAST(1000000000 AS DECIMAL(10, 0)) * CAST({count} + 2 AS DECIMAL(20, 0))) DIV NULLIF(CAST({n} + 2 * v AS DECIMAL(20, 0)), 0)")


def divergence(p, q):
    """floor((p - q)**2 / (p + q)) of integers (numpy or plain)."""
    return (p - q) * (p - q) // (p + q)


def _cell(rows: pa.Table) -> pa.Table:
    """Prices of all pairs of groups, one of each block of groups, over one block of terms.

    Rows without a term name the groups, with their p at no occurrences.
    """
    marks = rows.filter(pc.is_null(rows.column("term")))
    rows = rows.filter(pc.is_valid(rows.column("term")))
    lang, band, ga, gb = (marks.column(c)[0].as_py() for c in ("lang", "band", "ga", "gb"))
    base = band == BASE
    sources = marks.column("source").to_pylist()
    order = sorted(range(len(sources)), key=lambda k: sources[k])
    sources = [sources[k] for k in order]
    own, p0, v = (np.array([marks.column(c)[k].as_py() or 0 for k in order], dtype=np.int64) for c in ("own", "p", "v"))
    left, right = np.flatnonzero(own == ga), np.flatnonzero(own == gb)
    value = np.zeros((len(left), len(right)), dtype=np.int64)
    zeros = divergence(p0[left][:, None], np.maximum(p0[right], 1)[None, :])  # p0 is 0 only where nothing is kept
    if base:
        value = v[left][:, None] * zeros
    elif len(rows):
        at = {s: k for k, s in enumerate(sources)}
        terms = rows.column("term").combine_chunks().dictionary_encode()
        terms = (terms.combine_chunks() if isinstance(terms, pa.ChunkedArray) else terms).indices.to_numpy(zero_copy_only=False)
        column = np.array([at[s] for s in rows.column("source").to_pylist()])
        levels = np.tile(p0, (terms.max() + 1, 1))
        levels[terms, column] = rows.column("p").to_numpy()
        one, two = _indicators(levels, left), _indicators(levels, right)
        for x, p, i in one:
            for y, q, j in two:
                if ga == gb and i[0] > j[-1]:
                    continue
                joint = x.T @ y  # terms at both levels
                r, c = np.nonzero(joint)
                price = divergence(p[r], q[c]) - zeros[i[r], j[c]]
                np.add.at(value, (i[r], j[c]), joint[r, c].astype(np.int64) * price)
    a, b = np.nonzero(np.ones_like(value) if base else value)
    if ga == gb:
        a, b = a[a < b], b[a < b]
    return pa.table(
        {"lang": pa.array([lang] * len(a), pa.string()), "a": pa.array([sources[left[k]] for k in a], pa.string()), "b": pa.array([sources[right[k]] for k in b], pa.string()), "value": pa.array(value[a, b])}
    )


def _indicators(levels: np.ndarray, groups: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """0/1 matrices of a block's terms: (matrix, level of each column, place of its group among ``groups``)."""
    out, parts = [], []

    def matrix():
        level, place = (np.concatenate([part[k] for part in parts]) for k in (0, 2))
        x = np.zeros((len(levels), len(level)), dtype=np.float32)
        first = 0
        for own, column, _ in parts:
            x[np.arange(len(levels)), first + column] = 1
            first += len(own)
        parts.clear()
        return x, level, place

    for k, g in enumerate(groups):
        own, column = np.unique(levels[:, g], return_inverse=True)
        if parts and sum(len(p[0]) for p in parts) + len(own) > COLUMN_BLOCK:
            out.append(matrix())
        parts.append((own, column, np.full(len(own), k)))
    if parts:
        out.append(matrix())
    return out


def kept_counts(documents: DataFrame, min_docs: int = MIN_DOCS) -> tuple[DataFrame, DataFrame]:
    """(groups, kept): groups(lang, source, v, n_group, n_lang, n_sources, own) and kept(lang, source, term, n, lang_n, first, band)."""
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    rows = documents.select(empty("lang"), empty("source"), F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"))
    counts = rows.mapInArrow(_counted, "lang string, source string, term string, n long, docs long")
    # the tasks have added up what they can, so a second sum on their side would only cost time
    counts = written(counts.repartition("lang", "source", "term").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "counts")
    by_term = Window.partitionBy("lang", "term")
    kept = counts.where("term IS NOT NULL").withColumn("df", F.sum("docs").over(by_term)).withColumn("lang_n", F.sum("n").over(by_term))
    kept = kept.withColumn("first", F.col("source") == F.min("source").over(by_term)).where(F.col("df") >= min_docs)
    kept = written(kept.select("lang", "source", "term", "n", "lang_n", "first", F.floor(F.log2("lang_n")).cast("int").alias("band")), "kept")
    per_group = kept.groupBy("lang", "source").agg(F.sum("n").alias("n_group"), F.sum(F.col("first").cast("long")).alias("firsts"))
    groups = counts.where("term IS NULL").select("lang", "source").join(per_group, ["lang", "source"], "left")
    per_lang = written(groups.groupBy("lang").agg(F.sum("firsts").alias("v"), F.sum("n_group").alias("n_lang"), F.count("*").alias("n_sources")), "langs")
    groups = groups.join(broadcast_if_small(per_lang), "lang").na.fill(0, ["v", "n_group", "n_lang"])
    own = F.pmod(F.xxhash64("source"), F.ceil(F.col("n_sources") / GROUP_BLOCK)).alias("own")
    return written(groups.select("lang", "source", "v", "n_group", "n_lang", "n_sources", own), "groups"), kept


def audit(documents: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value and rank: see the module."""
    groups, kept = kept_counts(documents, min_docs)
    small_groups = broadcast_if_small(groups)
    rows = kept.join(small_groups, ["lang", "source"]).withColumn("p", _p("n", "n_group")).withColumn("q", _p("lang_n", "n_lang"))

    told = rows.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), F.expr("((p - q) * (p - q)) DIV (p + q)").alias("value"))
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    told = told.withColumn("rank", F.row_number().over(by_value)).where(F.col("rank") <= top)

    bands = kept.where("first").groupBy("lang", "band").agg(F.ceil(F.count("*") / TERM_BLOCK).alias("parts"))
    bands = written(bands.unionByName(groups.select("lang", F.lit(BASE).alias("band"), F.lit(1).cast("long").alias("parts")).distinct()), "bands")
    small_bands = broadcast_if_small(bands)
    columns = ["lang", "band", "part", "source", "own", "n_sources", "term", "p", "v"]
    marks = groups.withColumn("p", _p("0", "n_group")).join(small_bands, "lang").withColumn("part", F.explode(F.expr("sequence(0L, parts - 1)")))
    seen = rows.join(small_bands, ["lang", "band"]).withColumn("part", F.pmod(F.xxhash64("term"), F.col("parts")))
    cells = seen.select(columns).unionByName(marks.withColumn("term", F.lit(None).cast("string")).select(columns))
    cells = cells.withColumn("other", F.explode(F.expr(f"sequence(0L, CAST(ceil(n_sources / {GROUP_BLOCK}) AS BIGINT) - 1)")))
    cells = cells.select("lang", "band", "part", F.least("own", "other").alias("ga"), F.greatest("own", "other").alias("gb"), "source", "own", "term", "p", "v")
    priced = cells.groupBy("lang", "band", "part", "ga", "gb").applyInArrow(_cell, "lang string, a string, b string, value long")
    priced = priced.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    sides = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item"))))
    pairs = priced.select("lang", sides.alias("s"), "value").select("lang", "s.source", F.lit("pair").alias("part"), "s.item", "value")
    pairs = pairs.withColumn("rank", F.row_number().over(by_value))
    return pairs.unionByName(told)


def op12_source_divergence(spark, sf_dir):
    return audit(table(spark, sf_dir, "documents"))


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
g AS (SELECT DISTINCT lang, source FROM d),
w AS (SELECT rid, lang, source, translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM d),
k AS (SELECT lang, term, count(*) AS n FROM w GROUP BY lang, term HAVING count(DISTINCT rid) >= 10),
l AS (SELECT lang, count(*) AS v, sum(n) AS n FROM k GROUP BY lang),
c AS (SELECT w.lang, w.source, w.term, count(*) AS n FROM w JOIN k ON w.lang = k.lang AND w.term = k.term GROUP BY ALL),
s AS (SELECT lang, source, sum(n) AS n FROM c GROUP BY lang, source),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
             1 + (CAST(1000000000 AS HUGEINT) * (coalesce(c.n, 0) + 2)) // (CAST(coalesce(s.n, 0) AS HUGEINT) + 2 * l.v) AS p,
             1 + (CAST(1000000000 AS HUGEINT) * (k.n + 2)) // (CAST(l.n AS HUGEINT) + 2 * l.v) AS q
      FROM g JOIN k ON g.lang = k.lang JOIN l ON l.lang = g.lang LEFT JOIN s ON s.lang = g.lang AND s.source = g.source
      LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
f AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
      FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
r AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0) AS value
      FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
      UNION ALL
      SELECT lang, source, 'term', term, ((p - q) * (p - q)) // (p + q) FROM p WHERE n > 0 AND p > q),
o AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM r)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM o WHERE part = 'pair' OR rank <= 10
"""

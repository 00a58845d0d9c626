"""Benchmark decontamination by SimHash over item-sized windows, in DataFrame functions only.

Texts are lower-cased words (runs of letters and digits); their shingles are
all runs of ``SHINGLE`` words, or the whole sequence as one if there are fewer.  A
window has as many shingles as the benchmark item it is held against (fewer
where the text ends), and its similarity to the item is the weighted Jaccard
similarity of their shingles, the weight being the number of times each
comes: sum of least weights / sum of largest.  A document is contaminated by an
item if one of its windows reaches ``threshold``.

1. Windows.  Only a window in which enough shingles occur in the benchmark can
   reach the threshold, and of such windows the one that starts at its first
   such shingle is at least as similar.  So windows start at shingles that the
   benchmark has, and hold threshold * size of them; the others need no
   fingerprint.
2. SimHash.  Each bit of a window's 64-bit fingerprint is the majority of that
   bit over its shingles' hashes, every occurrence counting.
3. Multi-index Hamming blocks.  Fingerprints are cut into ``BLOCKS`` blocks.  Two
   within ``radius`` bits agree in some block up to radius // BLOCKS bits, so
   the index has each item's blocks with every pattern of so many bits
   flipped, and an equality join on (size, block, value) finds all fingerprints within the
   radius; bit_count of the difference drops the others.
4. Candidates are verified by the exact similarity.

At radius 19 a window with a similarity of 0.8 stays outside with a
probability of about 0.001 (the angle of such multisets is 27 degrees, so its
distance has a mean of 9.7 bits and a deviation of 2.9), and one of 0.9 or more practically never.

Null or empty texts and items have no shingles and match nothing.  Items of
fewer than five words match only texts of just these words.  Rows with equal doc_id and text count once; a null doc_id is a
value like any other.  Repeated items are reported by each id.  Empty tables give no rows.
Extra columns are dropped by ``find_contaminated`` and kept by ``remove_contaminated``.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surfrank.llm.tables import broadcast_if_small, likely, settled, table, without, written

SHINGLE = 5
THRESHOLD = 0.8
RADIUS, BLOCKS = 19, 4
BLOCK_BITS = 64 // BLOCKS


def _among(rows: DataFrame, keys: DataFrame, *on: str, key: str) -> DataFrame:
    """``rows`` joined with a written table: a broadcast if it is small, measured in bytes, else a shuffle of the rows that its column ``key`` lets pass."""
    small = broadcast_if_small(keys)
    return rows.join(small, list(on)) if small is not keys else likely(rows, keys, key).join(keys.hint("merge"), list(on))


def with_shingles(texts: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns and the shingles' hashes in order (column hs)."""
    # the one-element array binds w once; a column of its own would be put into the lambda and split again for each shingle
    hashes = ", ".join(f"w[i + {j}]" for j in range(SHINGLE))
    every = f"transform(sequence(0, size(w) - {SHINGLE}), i -> xxhash64({hashes}))"
    whole = "IF(size(w) > 0, array(xxhash64(array_join(w, ' '))), CAST(array() AS array<bigint>))"
    words = r"filter(split(lower(text), '[^\\p{L}\\p{N}]+'), x -> x <> '')"
    return texts.where("text IS NOT NULL").select(*keep, F.expr(f"transform(array({words}), w -> IF(size(w) >= {SHINGLE}, {every}, {whole}))[0]").alias("hs"))


def with_fingerprint(rows: DataFrame) -> DataFrame:
    """Adds fp, the SimHash of the hashes hs.  Two bits are counted in the halves of one long."""
    counts = "transform(sequence(0, 31), p -> aggregate(hs, 0L, (a, h) -> a + (shiftrightunsigned(h, p) & 4294967297L)))"
    fp = (
        "aggregate(sequence(0, 31), 0L, (f, p) -> f"
        " | IF((c[p] & 4294967295L) * 2 > size(hs), shiftleft(1L, p), 0L)"
        " | IF(shiftrightunsigned(c[p], 32) * 2 > size(hs), shiftleft(1L, p + 32), 0L))"
    )
    return rows.withColumn("fp", F.expr(f"transform(array({counts}), c -> {fp})[0]"))


def blocks(rows: DataFrame, *keep: str) -> DataFrame:
    """A row for each block of fp: (keep, fp, block, value)."""
    return rows.select(*keep, "fp", F.posexplode(F.expr(f"transform(sequence(0, {BLOCKS - 1}), b -> shiftrightunsigned(fp, {BLOCK_BITS} * b) & {(1 << BLOCK_BITS) - 1}L)")).alias("block", "value"))


def find_contaminated(documents: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, radius: int = RADIUS) -> DataFrame:
    """(doc_id, text_key, item_id, similarity): each document's best window for each item that it holds.

    text_key is a hash of the text, which tells rows of one doc_id apart.
    """
    items = settled(with_shingles(benchmark.select("item_id", "text"), ["item_id"]).where("size(hs) > 0").withColumn("n", F.size("hs")))
    known = settled(items.select(F.explode("hs").alias("h"), "n").groupBy("h").agg(F.collect_set("n").alias("ns")))
    docs = documents.select("doc_id", F.xxhash64("text").alias("text_key"), "text")

    # windows: (doc_id, text_key) -> starts [(at, n)]
    anchors = with_shingles(docs, ["doc_id", "text_key"]).select("doc_id", "text_key", F.posexplode("hs").alias("at", "h"))
    found = _among(anchors, known, "h", key="h")
    found = found.groupBy("doc_id", "text_key").agg(F.sort_array(F.collect_set(F.struct("at", "ns"))).alias("hits"))
    enough = f"coalesce(get(hits, i + CAST(ceil({threshold} * n) AS INT) - 1).at < x.at + n, false)"
    starts = F.expr(f"flatten(transform(hits, (x, i) -> transform(filter(x.ns, n -> {enough}), n -> struct(x.at AS at, n AS n))))")
    found = written(found.select("doc_id", "text_key", starts.alias("starts")).where("size(starts) > 0"), "windows")

    same = lambda a, b: a["doc_id"].eqNullSafe(b["doc_id"]) & (a["text_key"] == b["text_key"])
    docs = likely(docs, found.select("text_key").distinct(), "text_key")  # only texts with windows are shuffled
    docs = with_shingles(docs.dropDuplicates(["doc_id", "text_key"]), ["doc_id", "text_key"])
    windows = docs.join(found, same(docs, found)).select(docs["doc_id"], docs["text_key"], "hs", F.explode("starts").alias("s"))
    windows = windows.select("doc_id", "text_key", F.col("s.at").alias("at"), F.col("s.n").alias("n"), F.expr("slice(hs, s.at + 1, s.n)").alias("hs"))
    windows = written(with_fingerprint(windows), "fingerprints")

    # candidates: pairs of fingerprints within the radius, each pair once however many windows have it
    flips = [x for x in range(1 << BLOCK_BITS) if x.bit_count() <= radius // BLOCKS]
    prints = with_fingerprint(items)
    index = blocks(prints.select("n", "fp").distinct(), "n").withColumn("flip", F.explode(F.lit(flips).cast("array<bigint>")))
    index = index.select("n", "block", F.col("value").bitwiseXOR(F.col("flip")).alias("value"), F.col("fp").alias("item_fp"))
    near = blocks(windows.select("n", "fp").distinct(), "n").join(index.hint("merge"), ["n", "block", "value"])  # thousands of rows for each item: no broadcast
    near = near.where(F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))) <= radius).select("n", "fp", "item_fp").distinct()
    near = settled(near.join(prints.select("n", F.col("fp").alias("item_fp"), "item_id"), ["n", "item_fp"]).select("n", "fp", "item_id"))

    # the exact similarity; what a window and an item have in common is summed over their shingles
    weights = settled(items.select("item_id", F.explode("hs").alias("h")).groupBy("item_id", "h").agg(F.count("*").alias("item_weight")))
    tested = windows.join(near, ["n", "fp"]).select("doc_id", "text_key", "at", "n", "item_id", F.size("hs").alias("m"), F.explode("hs").alias("h"))
    tested = tested.groupBy("doc_id", "text_key", "at", "n", "m", "item_id", "h").agg(F.count("*").alias("weight"))
    common = _among(tested, weights, "item_id", "h", key="h").groupBy("doc_id", "text_key", "at", "n", "m", "item_id")
    common = common.agg(F.sum(F.least("weight", "item_weight")).alias("both"))
    common = common.withColumn("similarity", F.col("both") / (F.col("n") + F.col("m") - F.col("both")))
    return common.where(F.col("similarity") >= threshold).groupBy("doc_id", "text_key", "item_id").agg(F.max("similarity").alias("similarity"))


def remove_contaminated(documents: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, radius: int = RADIUS) -> DataFrame:
    """The rows of ``documents`` that hold no benchmark item, with all their columns."""
    found = find_contaminated(documents, benchmark, threshold, radius)
    row = lambda doc_id, text_key: F.to_json(F.struct(F.col(doc_id).alias("d"), text_key.alias("k")))  # noqa: E731  a null doc_id is a value
    bad = settled(found.select(row("doc_id", F.col("text_key")).alias("contaminated_row")).distinct())
    return without(documents.withColumn("contaminated_row", row("doc_id", F.xxhash64("text"))), bad, "contaminated_row").select(documents.columns)


def op1_decontamination(spark, sf_dir):
    found = find_contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.groupBy("doc_id", "item_id").agg(F.round(F.max("similarity"), 9).alias("similarity"))


SQL = r"""
WITH t AS (SELECT 0 AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 1, item_id, text FROM benchmark),
w AS (SELECT kind, id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM t),
p AS (SELECT kind, id, w, len(w) AS n, unnest(range(1, greatest(len(w) - 3, 2))) AS pos FROM w WHERE len(w) > 0),
s AS (SELECT kind, id, pos, array_to_string(w[pos:pos + 4], ' ') AS s, greatest(n - 4, 1) AS n FROM p),
i AS (SELECT id AS item_id, s, n, count(*) AS ci FROM s WHERE kind = 1 GROUP BY ALL),
h AS (SELECT d.id AS doc_id, d.pos, d.s, d.n AS dn, i.item_id, i.n, i.ci FROM s d JOIN i ON d.s = i.s WHERE d.kind = 0),
x AS (SELECT a.doc_id, a.item_id, a.pos, a.n, least(a.n, a.dn - a.pos + 1) AS m, b.s, least(count(*), b.ci) AS c
      FROM h a JOIN h b ON a.doc_id = b.doc_id AND a.item_id = b.item_id AND b.pos >= a.pos AND b.pos < a.pos + a.n
      GROUP BY a.doc_id, a.item_id, a.pos, a.n, a.dn, b.s, b.ci),
y AS (SELECT doc_id, item_id, sum(c) / (n + m - sum(c)) AS similarity FROM x GROUP BY doc_id, item_id, pos, n, m)
SELECT doc_id, item_id, round(max(similarity), 9) AS similarity FROM y WHERE similarity >= 0.8 GROUP BY doc_id, item_id
"""

"""Removal of repeated passages: Rabin-Karp hashes of every window of words, counted in Spark.

A window is ``window`` consecutive words of one document.  Each word covered by
a window whose word sequence also starts anywhere else (in the same document
too) is removed; overlapping repeated windows merge into maximal intervals.
All windows are judged on the input.

Documents are dealt to chunks of about ``chunk_bytes`` by a hash of the row.
A chunk's window hashes are made distinct, with a bit for those that the chunk
itself repeats, and cut by value into buckets, so a row of the shuffle holds a
chunk's hashes of one bucket and a passage that very many documents share
counts once for each chunk.  A bucket's task finds the hashes that come twice
and returns one bit for each hash it was sent.  Chunks then meet their bits
again, hash their windows once more, and cut.  Both numbers of parts follow the
text's size, so neither a chunk nor a bucket grows with the input.

Windows are equal if the 64-bit polynomial hashes of their words' 64-bit hashes
are.  With n windows in all, a window is taken for repeated by mistake with a
probability of about n / 2**64.

Null and empty texts have no words and are kept as an empty text; texts of fewer words
than a window lose nothing.  Repeated rows repeat each other's windows, so they
lose all the words that windows cover.  No rows give no rows; other columns of
the documents pass through unless they are not asked for.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from surfrank.llm.tables import table
from surfrank.llm.text import mix, run_sums, text_buffers, words_of

WINDOW = 35
CHUNK_BYTES = 4 << 20
#: Bytes of text whose window hashes meet in a bucket (a window for about six bytes).
BUCKET_BYTES = 12 << 20
#: Windows hashed in one go.
SLICE_WINDOWS = 1 << 15
_WINDOW_BASE = 0xC2B2AE3D27D4EB4F
_U = np.uint64


def _windows(texts: pa.ChunkedArray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes of all windows, the word each starts at, word offsets of the texts)."""
    words, offsets = words_of(texts)
    starts = np.arange(len(words), dtype=np.int64)
    left = np.repeat(offsets[1:], np.diff(offsets)) - starts
    starts = starts[left >= window]
    del left
    hashes = np.empty(len(starts), dtype=np.uint64)
    for k in range(0, len(starts), SLICE_WINDOWS):  # a window's hash doesn't depend on where its slice begins
        some = starts[k : k + SLICE_WINDOWS]
        first, end = int(some[0]), int(some[-1]) + window
        hashes[k : k + SLICE_WINDOWS] = mix(run_sums(words[first:end], some - first, some - first + window, _WINDOW_BASE))
    return hashes, starts, offsets


def _bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets are ranges of hashes, so sorted hashes have sorted buckets."""
    return ((hashes >> _U(32)) * _U(buckets)) >> _U(32)


def _send(window: int, buckets: int):
    def send(chunk: pa.Table) -> pa.Table:
        hashes, _, _ = _windows(chunk.column("text"), window)
        distinct, counts = np.unique(hashes, return_counts=True)
        bucket = _bucket_of(distinct, buckets)
        cuts = np.flatnonzero(np.diff(bucket.astype(np.int64), prepend=-1)) if len(bucket) else np.zeros(0, dtype=np.int64)
        ends = np.append(cuts[1:], len(bucket)) if len(cuts) else cuts
        number = chunk.column("chunk")[0].as_py()
        return pa.table(
            {
                "chunk": pa.array([number] * len(cuts), pa.int64()),
                "bucket": pa.array(bucket[cuts].astype(np.int64), pa.int64()),
                "hashes": pa.array([distinct[a:b].tobytes() for a, b in zip(cuts, ends)], pa.binary()),
                "again": pa.array([np.packbits(counts[a:b] > 1).tobytes() for a, b in zip(cuts, ends)], pa.binary()),
            }
        )

    return send


def _meet(bucket: pa.Table) -> pa.Table:
    data, offsets = text_buffers(bucket.column("hashes"))
    hashes = data.view(np.uint64)  # all that was sent, where Arrow has it
    sent = [hashes[a:b] for a, b in zip(offsets[:-1] // 8, offsets[1:] // 8)]
    here = [s[np.unpackbits(np.frombuffer(x, dtype=np.uint8), count=len(s)).astype(bool)] for x, s in zip(bucket.column("again").to_pylist(), sent)]
    together = np.sort(hashes)
    repeated = together[1:][together[1:] == together[:-1]]
    del together
    repeated = np.unique(np.concatenate([repeated, *here]))
    return pa.table(
        {
            "chunk": bucket.column("chunk"),
            "bucket": bucket.column("bucket"),
            "bits": pa.array([np.packbits(_among(s, repeated)).tobytes() for s in sent], pa.binary()),
        }
    )


def _among(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if len(ordered) == 0:
        return np.zeros(len(values), dtype=bool)
    at = np.searchsorted(ordered, values)
    at[at == len(ordered)] = 0
    return ordered[at] == values


def _cut(window: int, buckets: int, keep: list[str], always: bool):
    def cut(chunk: pa.Table, bits: pa.Table) -> pa.Table:
        hashes, starts, offsets = _windows(chunk.column("text"), window)
        distinct = np.unique(hashes)
        sizes = np.bincount(_bucket_of(distinct, buckets).astype(np.int64), minlength=buckets) if len(distinct) else np.zeros(buckets, dtype=np.int64)
        flags = np.zeros(len(distinct), dtype=bool)
        firsts = np.cumsum(sizes) - sizes
        for b, x in zip(bits.column("bucket").to_pylist(), bits.column("bits").to_pylist()):
            flags[firsts[b] : firsts[b] + sizes[b]] = np.unpackbits(np.frombuffer(x, dtype=np.uint8), count=int(sizes[b])).astype(bool)
        hit = starts[_among(hashes, distinct[flags])]
        edge = np.zeros(int(offsets[-1]) + 1, dtype=np.int64)
        np.add.at(edge, hit, 1)
        np.add.at(edge, hit + window, -1)
        covered = np.cumsum(edge)[:-1] > 0
        before = np.concatenate([[0], np.cumsum(covered)])
        removed = before[offsets[1:]] - before[offsets[:-1]]
        texts = []
        for k, text in enumerate(chunk.column("text").to_pylist()):
            if removed[k]:
                texts.append(b" ".join(compress(text.encode().split(), (~covered[offsets[k] : offsets[k + 1]]).tolist())).decode())
            else:
                texts.append(b" ".join((text or "").encode().split()).decode() if always else text)
        out = {name: chunk.column(name) for name in keep}
        out |= {"n_words": pa.array(np.diff(offsets), pa.int64()), "n_removed": pa.array(removed.astype(np.int64)), "kept_text": pa.array(texts, pa.string())}
        return pa.table(out)

    return cut


def remove_repeats(documents: DataFrame, window: int = WINDOW, keep: list[str] | None = None, always_join: bool = False, chunk_bytes: int = CHUNK_BYTES, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """The ``keep`` columns of each row, n_words, n_removed and kept_text.

    kept_text has the words that are kept, joined by one space; a text that
    loses nothing stays as it is, unless ``always_join``.
    """
    keep = keep or ["doc_id"]
    names = {c: f"c{k}" for k, c in enumerate(keep)}  # so that no column clashes with the operator's own
    rows = documents.select(*[F.col(c).alias(names[c]) for c in keep], F.col("text").cast("string").alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks, buckets = max(1, -(-total // chunk_bytes)), max(1, -(-total // bucket_bytes))
    rows = rows.withColumn("chunk", F.pmod(F.xxhash64(*[names[c] for c in keep[:1]], "text"), F.lit(chunks)))
    sent = rows.groupBy("chunk").applyInArrow(_send(window, buckets), "chunk long, bucket long, hashes binary, again binary")
    bits = sent.groupBy("bucket").applyInArrow(_meet, "chunk long, bucket long, bits binary")
    schema = T.StructType([T.StructField(names[c], rows.schema[names[c]].dataType) for c in keep])
    schema = schema.add("n_words", T.LongType()).add("n_removed", T.LongType()).add("kept_text", T.StringType())
    out = rows.groupBy("chunk").cogroup(bits.groupBy("chunk")).applyInArrow(_cut(window, buckets, [names[c] for c in keep], always_join), schema)
    return out.select(*[F.col(names[c]).alias(c) for c in keep], "n_words", "n_removed", "kept_text")


def op8_substring_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumn("doc_id", F.col("doc_id").cast("long"))
    out = remove_repeats(docs, always_join=True)
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.encode("kept_text", "UTF-8"), 256).alias("kept_sha256"))


SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 33, 1))) AS pos FROM d),
q AS (SELECT doc_id, pos, md5(array_to_string(w[pos:pos + 34], ' ')) AS h FROM p),
r AS (SELECT h FROM q GROUP BY h HAVING count(*) > 1),
c AS (SELECT DISTINCT doc_id, unnest(range(pos, pos + 35)) AS spot FROM q WHERE h IN (SELECT h FROM r)),
g AS (SELECT doc_id, list(spot) AS gone FROM c GROUP BY doc_id),
k AS (SELECT d.doc_id, len(w) AS n, coalesce(len(gone), 0) AS m,
             CASE WHEN gone IS NULL THEN w ELSE [w[i] for i in range(1, len(w) + 1) if NOT list_contains(gone, i)] END AS kept
      FROM d LEFT JOIN g ON d.doc_id = g.doc_id)
SELECT doc_id, CAST(n AS BIGINT) AS n_words, CAST(m AS BIGINT) AS n_removed, sha256(coalesce(array_to_string(kept, ' '), '')) AS kept_sha256 FROM k
"""

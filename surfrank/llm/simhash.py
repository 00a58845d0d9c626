"""Near duplicates by SimHash fingerprints that differ in few bits.

A text's words are its runs of bytes other than white space, A-Z folded; its
shingles are all runs of ``size`` words joined by one space, repeats included (of fewer
words the whole sequence is one).  A fingerprint has 64 bits; each is 1 if it is
set in more than half of the shingles' XXH64 hashes.  Texts without words have
fingerprint 0.  Fingerprints link at ``radius`` or fewer differing bits, and
links make components.  From here on all work is on distinct fingerprints, so
exact copies cost nothing.

Pigeonhole blocks: of ``blocks`` equal parts of the 64 bits, two linked fingerprints
have at least ``blocks - radius`` in common.  So a bucket is a choice of that many
parts with their values, and linked fingerprints meet in one of the buckets:
with 4 parts and radius 2 there are 6 choices of 32 bits, which unrelated
fingerprints share with a probability of 2**-32 each.  A bucket of up to
``BUCKET_ROWS`` fingerprints is gathered, and each pair's Hamming distance is
verified in it; it returns a spanning forest of its links, fewer than its members.

Related fingerprints (a large group of near copies) can fill a bucket without
bound.  The fingerprints of larger buckets go through finer blocks instead:
with 16 parts a bucket fixes 56 bits and so has at most 2**8 members, whatever
the data.  Two fingerprints that only meet in large buckets both take part
there, so no link is lost, and work stays in proportion to the fingerprints.

Null or empty texts have fingerprint 0 and link like any other.  Rows of one
doc_id are one document: what any of them reaches belongs together.  Rows with a
null doc_id get a fingerprint, take no part in links and have a null component.
No rows give no rows.  Extra columns are dropped.  A long text is hashed in
slices, so working memory doesn't grow with it beyond the text itself.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surfrank.llm.graph import components
from surfrank.llm.tables import broadcast_if_small, likely, settled, table, written

SIZE, RADIUS = 3, 2
SEED = 42
#: Parts of a fingerprint: of the first buckets, and of those for crowded ones (2**8 members at most at radius 2).
BLOCKS, FINE_BLOCKS = 4, 16
#: Fingerprints of a bucket that is gathered; at least 2**(64 * radius / FINE_BLOCKS).
BUCKET_ROWS = 256
#: Bytes of a text that are hashed in one go.
SLICE_BYTES = 1 << 20
_LOWER = bytes(c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))
_SPACE = b" \t\n\v\f\r"


def _parts(text: bytes) -> Iterator[bytes]:
    """The text in slices of about SLICE_BYTES that end at white space."""
    at = 0
    while at < len(text):
        end = at + SLICE_BYTES
        while end < len(text) and text[end] not in _SPACE:
            end += 1
        yield text[at:end]
        at = end


def _bit_counts(hashes: list[int]) -> np.ndarray:
    bits = np.unpackbits(np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.sum(axis=0, dtype=np.int64)


def fingerprint(text: bytes | None, size: int = SIZE) -> int:
    """The text's SimHash as an unsigned integer."""
    counts, n, carry = np.zeros(64, dtype=np.int64), 0, []
    for part in _parts(text or b""):
        words = carry + part.translate(_LOWER).split()
        if len(words) < size:
            carry = words
            continue
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
        starts = np.concatenate([[0], ends[:-1] + 1])
        counts += _bit_counts([xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist())])
        n += len(words) - size + 1
        carry = words[len(words) - size + 1 :]
    if n == 0 and carry:
        counts, n = _bit_counts([xxhash.xxh64_intdigest(b" ".join(carry), SEED)]), 1
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def _fingerprints(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(x, size) for x in batch.column("text").to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found.view(np.int64))], names=["doc_id", "fp"])

    return run


def fingerprints(documents: DataFrame, size: int = SIZE) -> DataFrame:
    """(doc_id, fp) of each row, fp as a signed long."""
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    return rows.mapInArrow(_fingerprints(size), "doc_id long, fp long")


def bucket_keys(fps: DataFrame, blocks: int, radius: int) -> DataFrame:
    """A row for each bucket of a fingerprint: (choice, bits, fp, node); a bucket is a choice of parts with their bits."""
    bits = 64 // blocks
    keys = []
    for choice, parts in enumerate(itertools.combinations(range(blocks), blocks - radius)):
        mask = sum(((1 << bits) - 1) << bits * b for b in parts)
        signed = mask - (1 << 64) if mask >> 63 else mask
        keys.append(F.struct(F.lit(choice).alias("choice"), F.col("fp").bitwiseAND(F.lit(signed)).alias("bits")))
    return fps.select(F.explode(F.array(*keys)).alias("k"), "fp", "node").select("k.choice", "k.bits", "fp", "node")


def _linked(radius: int):
    """Links of the pairs of a bucket within the radius: a spanning forest, each as (a, b) of nodes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = [], []
            for members in batch.column("members").to_pylist():
                fps = np.array([m["fp"] for m in members], dtype=np.int64).view(np.uint64)
                nodes = [m["node"] for m in members]
                near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= radius
                left = set(range(len(fps)))
                while left:
                    queue = [left.pop()]
                    while queue:
                        i = queue.pop()
                        for j in [j for j in np.flatnonzero(near[i]).tolist() if j in left]:
                            left.discard(j)
                            queue.append(j)
                            if nodes[i] != nodes[j]:
                                a.append(min(nodes[i], nodes[j]))
                                b.append(max(nodes[i], nodes[j]))
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


def _gathered(rows: DataFrame, radius: int) -> DataFrame:
    """Links within buckets of bounded size."""
    members = rows.groupBy("choice", "bits").agg(F.collect_list(F.struct("fp", "node")).alias("members")).where("size(members) > 1")
    return members.select("members").mapInArrow(_linked(radius), "a long, b long")


def links(fps: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, fine_blocks: int = FINE_BLOCKS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(a, b): nodes that join all fingerprints of ``fps`` (fp, node; distinct fp) that links join."""
    rows = bucket_keys(fps, blocks, radius)
    counts = written(rows.groupBy("choice", "bits").agg(F.count("*").alias("n")).where("n > 1"), "buckets")
    plain = counts.where(F.col("n") <= bucket_rows).select("choice", "bits")
    crowded = written(counts.where(F.col("n") > bucket_rows).select("choice", "bits"), "crowded")
    hot = not crowded.isEmpty()
    if hot:
        side = broadcast_if_small(crowded)
        fine = written(rows.join(side, ["choice", "bits"], "left_semi").select("fp", "node").distinct(), "fine")
        rows = rows.join(side, ["choice", "bits"], "left_anti")  # a crowded bucket is in no exchange by its key
    # most fingerprints are alone in their buckets: the filter keeps them out of the exchange
    rows = likely(rows.withColumn("h", F.xxhash64("choice", "bits")), plain.select(F.xxhash64("choice", "bits").alias("h")), "h").drop("h")
    found = _gathered(rows.join(plain, ["choice", "bits"], "left_semi"), radius)
    if hot:
        found = found.unionByName(_gathered(bucket_keys(fine, fine_blocks, radius), radius))
    return written(found.distinct(), "links")


def near_duplicates(documents: DataFrame, size: int = SIZE, radius: int = RADIUS, **limits: int) -> DataFrame:
    """doc_id, fp and component_id of each row."""
    rows = written(fingerprints(documents, size), "fingerprints")
    known = rows.where("doc_id IS NOT NULL")
    classes = written(known.groupBy("fp").agg(F.min("doc_id").alias("node")), "classes")
    found = links(classes, radius, **limits)
    # a document of several rows with different fingerprints joins their classes
    several = written(known.groupBy("doc_id").agg(F.min("fp").alias("lo"), F.max("fp").alias("hi")).where("lo <> hi").select("doc_id"), "several")
    if not several.isEmpty():
        own = known.join(broadcast_if_small(several), "doc_id", "left_semi").distinct().join(classes, "fp")
        found = found.unionByName(own.select(F.col("doc_id").alias("a"), F.col("node").alias("b")).where("a <> b"))
    named = classes.join(components(found), "node", "left").select("fp", F.coalesce("component", "node").alias("component_id"))
    named = settled(named)
    out = rows.join(named, "fp", "left")  # plain exchanges: a large class of copies can be split
    return out.select("doc_id", "fp", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))


def hex_digits(fp: str = "fp") -> F.Column:
    """A long as 16 lower-case hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def op13_simhash_near_dedup(spark, sf_dir):
    out = near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", hex_digits().alias("fingerprint"), "component_id")

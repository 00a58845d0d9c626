"""Mixing sources to target weights by packed blocks.

Each source's documents are laid end to end in a pseudorandom order and its
words packed into blocks of ``block_words``.  A source's target is its weighted
share of the output, at most ``max_repeat`` times its own size; what is above
is shared again by weight (the level at which this ends is found in closed
form from running sums over the sources).  The target is met by slots: whole
passes over the blocks, then a last pass that stops within a block, so that the
taken words equal the rounded target.  Output shards have ``shard_slots`` slots each (the
last has the rest).  The slots of all sources are dealt to them by multinomial draws of
the sources' counts: for the first half of the shards, then for each half of a half, down to
a single shard, each draw with the shares of what is left for it and corrected where it
takes more of a source than there is.  So every shard has multinomial counts, the totals
meet the targets, and a shard's counts and first slots follow from the draws above it
alone, without any other shard.  Slot q of a pass takes the
block at q in the source's pseudorandom permutation for that pass (a Feistel
network over the block numbers, walked until it stays in range), and the slots
are joined with the blocks by (source, block), in a shuffle join whatever their size.

No document is taken more than ``max_repeat`` times, as every pass has each
block once.  Draws depend on the seed and the sources' sizes alone, so reruns agree.  No step
gathers a source's documents: running sums go over buckets of documents, then over groups
of buckets, and the join's keys are blocks.  The table of sources (a row for each) is sorted in
one task and held by the driver and the tasks that draw: 32 bytes for a source.

Null source is a source of its own, sorted last; null or empty text has size 0
and is taken 0 times; a source without words has target 0.  Repeated rows are
rows like any other and are packed next to each other (rows of equal doc_id and text share a bucket).  An empty table gives no
rows.  Extra columns are dropped.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from surfrank.llm.tables import broadcast_if_small, settled, table
from surfrank.llm.text import WORD, mix

BLOCK_WORDS = 64
#: Slots of a shard.
SHARD_SLOTS = 1 << 16
#: Documents of a bucket on average, and buckets of a group: units of the running sums.
BUCKET_DOCS, GROUP_BUCKETS = 256, 1024
#: Tasks that draw and place, each for one shard or more.
MOST_TASKS = 20_000
WEIGHTS = (3, 1, 2)
_U = np.uint64


def sizes(documents: DataFrame) -> DataFrame:
    """doc_id, source, size (number of words) and a hash of the text of each row."""
    n = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0))
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), n.cast("long").alias("size"), F.xxhash64("text").alias("text_key"))


def targets(sized: DataFrame, weights=WEIGHTS, multiple: float = 1.5, max_repeat: int = 2) -> DataFrame:
    """source, source_no, source_size and target; a row per source.

    With sources in order of cap/weight, the level that fills the total is the
    largest of (total - caps before) / (weights from here on).
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    per = per.withColumn("source_no", F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1)
    w = F.array(*[F.lit(float(x)) for x in weights])
    per = per.withColumn("weight", F.element_at(w, (F.col("source_no") % len(weights) + 1).cast("int")))
    per = per.withColumn("cap", (F.col("source_size") * max_repeat).cast("double"))
    order = Window.orderBy(F.col("cap") / F.col("weight"), "source_no")
    all_rows = Window.partitionBy()
    caps_before = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    weights_here = F.sum("weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    per = per.withColumn("level", (F.sum("source_size").over(all_rows) * float(multiple) - caps_before) / weights_here)
    per = per.withColumn("level", F.max("level").over(all_rows))
    return per.select("source", "source_no", "source_size", F.least("cap", F.col("level") * F.col("weight")).alias("target"))


def laid_out(sized: DataFrame, sources: DataFrame, seed: int) -> DataFrame:
    """Each row with its source_no and the number of its source's words that lie before it (``start``)."""
    n = sized.count()
    buckets = max(1, -(-n // BUCKET_DOCS))
    rows = sized.join(broadcast_if_small(sources.select(F.col("source").alias("s"), "source_no")), F.col("source").eqNullSafe(F.col("s")))
    rows = rows.withColumn("key", F.xxhash64(F.lit(seed), "doc_id", "text_key")).select("doc_id", "source_no", "size", "key", F.pmod("key", F.lit(buckets)).alias("bucket"))
    rows = rows.withColumn("group", F.expr(f"bucket DIV {GROUP_BUCKETS}"))
    before = lambda part, *order: F.coalesce(F.sum("size").over(Window.partitionBy(*part).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    per_bucket = rows.groupBy("source_no", "group", "bucket").agg(F.sum("size").alias("size"))
    per_group = per_bucket.groupBy("source_no", "group").agg(F.sum("size").alias("size"))
    per_group = per_group.select("source_no", "group", before(["source_no"], "group").alias("group_start"))
    per_bucket = per_bucket.withColumn("bucket_start", before(["source_no", "group"], "bucket")).join(per_group, ["source_no", "group"])
    per_bucket = per_bucket.select("source_no", "bucket", (F.col("group_start") + F.col("bucket_start")).alias("bucket_start"))
    rows = rows.withColumn("inner", before(["source_no", "bucket"], "key", "doc_id", "size"))
    return rows.join(per_bucket, ["source_no", "bucket"]).select("doc_id", "source_no", "size", (F.col("bucket_start") + F.col("inner")).alias("start"))


def _half_bits(n: int) -> int:
    return max(1, (max(n - 1, 1).bit_length() + 1) // 2)


def _round(x: np.ndarray, key: int, h: int) -> np.ndarray:
    return mix(x + _U(key)) & _U((1 << h) - 1)


def _keys(seed: int, source: int, turn: int) -> list[int]:
    d = hashlib.blake2b(f"{seed}/{source}/{turn}".encode(), digest_size=32).digest()
    return [int.from_bytes(d[8 * k : 8 * k + 8], "little") for k in range(4)]


def permute(q: np.ndarray, n: int, keys: list[int], inverse: bool = False) -> np.ndarray:
    """A pseudorandom permutation of 0..n-1 at the places q: four Feistel rounds, walked into range."""
    h = _half_bits(n)
    low = _U((1 << h) - 1)
    out = q.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> _U(h), out[todo] & low
        for key in reversed(keys) if inverse else keys:
            if inverse:
                left, right = right ^ _round(left, key, h), left
            else:
                left, right = right, left ^ _round(right, key, h)
        out[todo] = left << _U(h) | right
        todo = todo[out[todo] >= n]
    return out.astype(np.int64)


def slot_plan(size: int, target: float, block_words: int, keys_of) -> tuple[int, int, int, int]:
    """(blocks, whole passes, slots of the last pass, words taken from its last slot) of a source."""
    want = round(target)
    if size <= 0 or want <= 0:
        return 0, 0, 0, 0
    n, (whole, rest) = -(-size // block_words), divmod(want, size)
    if rest == 0:
        return n, whole, 0, 0
    short = size - block_words * (n - 1)  # words of the last block, met at this place of the pass:
    place = int(permute(np.array([n - 1]), n, keys_of(whole), inverse=True)[0])
    slots = -(-rest // block_words)
    if place < slots:
        slots = -(-(rest + block_words - short) // block_words)
    before = block_words * (slots - 1) - (block_words - short if place < slots - 1 else 0)
    return n, whole, slots, rest - before


def dealt(shard: int, shards: int, slots: np.ndarray, shard_slots: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(first slot, number of slots) of each source in a shard."""
    first, left, low, high = np.zeros_like(slots), slots.copy(), 0, shards
    while high - low > 1:  # ``left`` are the slots of shards low .. high - 1
        middle = (low + high) // 2
        part = halved(left, (middle - low) * shard_slots, _keys(seed, low, high))
        if shard < middle:
            left, high = part, middle
        else:
            first, left, low = first + part, left - part, middle
    return first, left


def halved(slots: np.ndarray, n: int, key: list[int]) -> np.ndarray:
    """A multinomial draw of n of the slots; what is drawn of a source beyond its slots goes to those with most room."""
    rng = np.random.Generator(np.random.PCG64(key))
    part = rng.multinomial(n, slots / slots.sum())
    over = int(np.maximum(part - slots, 0).sum())
    part = np.minimum(part, slots)
    for k in np.argsort(part - slots, kind="stable"):
        if over == 0:
            break
        more = min(over, int(slots[k] - part[k]))
        part[k] += more
        over -= more
    return part


def _placed(sources: list[tuple[int, int, float]], shards: int, shard_slots: int, block_words: int, seed: int):
    """The slots of shards, drawn and mapped to blocks."""
    plans = {no: slot_plan(size, target, block_words, lambda t, no=no: _keys(seed, no, t)) for no, size, target in sources}
    slots = np.array([n * whole + last for n, whole, last, _ in plans.values()], dtype=np.int64)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.column("id").to_pylist():
                for source, begin, count in zip(plans, *(x.tolist() for x in dealt(shard, shards, slots, shard_slots, seed))):
                    n, whole, slots_of_last, last = plans[source]
                    for at in range(begin, begin + count, 1 << 16):
                        slot = np.arange(at, min(at + (1 << 16), begin + count), dtype=np.int64)
                        turn = slot // n
                        block = np.empty_like(slot)
                        for t in np.unique(turn):
                            here = turn == t
                            block[here] = permute(slot[here] - t * n, n, _keys(seed, source, int(t)))
                        words = np.full(len(slot), block_words, dtype=np.int64)
                        if slots_of_last:
                            words[slot == n * whole + slots_of_last - 1] = last
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(slot), source, dtype=np.int32)), pa.array(block), pa.array(np.full(len(slot), shard)), pa.array(slot), pa.array(words)],
                            names=["source_no", "block", "shard", "slot", "words"],
                        )

    return place, int(slots.sum())


def mix_documents(documents: DataFrame, weights=WEIGHTS, multiple: float = 1.5, max_repeat: int = 2, block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS, seed: int = 20):
    """(laid-out documents, sources, spans).

    Spans are the mix: shard, slot, source_no, block, doc_id, start (of the
    document in its source), first_word and n_words taken from the document.
    """
    sized = settled(sizes(documents))
    sources = settled(targets(sized, weights, multiple, max_repeat))
    laid = settled(laid_out(sized, sources, seed))
    spark = documents.sparkSession
    known = [(int(r["source_no"]), r["source_size"], r["target"]) for r in sources.orderBy("source_no").collect()]  # bounded by the number of sources, a row for each
    known = [x for x in known if x[1] and round(x[2]) > 0]
    n_slots = _placed(known, 1, shard_slots, block_words, seed)[1] if known else 0
    shards = max(1, -(-n_slots // shard_slots))
    place = _placed(known, shards, shard_slots, block_words, seed)[0]
    slots = spark.range(0, shards if n_slots else 0, 1, min(shards, MOST_TASKS)).mapInArrow(place, "source_no int, block long, shard long, slot long, words long")
    pieces = laid.where("size > 0").select(
        "doc_id", "source_no", "size", "start", F.explode(F.expr(f"sequence(start DIV {block_words}, (start + size - 1) DIV {block_words})")).alias("block")
    )
    begin = F.greatest("start", F.col("block") * block_words)
    end = F.least(F.col("start") + F.col("size"), F.col("block") * block_words + F.col("words"))
    spans = (
        slots.hint("merge").join(pieces, ["source_no", "block"])  # Spark can't tell how many slots a shard makes
        .select("shard", "slot", "source_no", "block", "doc_id", "start", (begin - F.col("start")).alias("first_word"), (end - begin).alias("n_words"))
        .where("n_words > 0")
    )
    return laid, sources, spans


def op4_mixing(spark, sf_dir):
    laid, sources, spans = mix_documents(table(spark, sf_dir, "documents"))
    taken = spans.groupBy("source_no", "start").agg(F.sum("n_words").alias("words"))
    # (source_no, start) names a row that has words
    rows = laid.join(taken, [laid.source_no == taken.source_no, laid.start == taken.start, laid.size > 0], "left").select(
        "doc_id", laid.source_no.alias("source_no"), "size", F.coalesce("words", F.lit(0)).alias("taken")
    )
    return rows.join(broadcast_if_small(sources), "source_no").select("doc_id", "size", "source_size", "target", F.col("taken").cast("long").alias("taken"))

"""Near duplicates by MinHash: keys of bands and signatures, confirmed on full sets.

A document's set is its distinct shingles of ``size`` words (A-Z folded; of
fewer words the whole sequence as one shingle).  Documents of equal sets (equal 128-bit digests of
all their hashes) form a class, with a number that is its smallest doc_id where that isn't
taken; all that follows is on classes.

Candidates: the least of each of many hash functions over a set; two sets agree
in one with the probability of their similarity s.  ``BAND_ROWS`` of them make the key of a band, so
sets share a key with a probability of s**4.  There are as many bands as a pair at the least similarity
needs to share none with a probability under ``MISSED`` (32 at 0.8).  A list is the classes of one key, and a key
that a single class has needs no list.  Sets with little in common, most pairs of any corpus, hardly
ever meet, so lists don't fill with them as the corpus grows.

Signatures: two bits of each of ``FIELDS`` least hashes, 16 bytes that go with a class into
its lists.  A pair of a list passes by size and by the fields in which its signatures
differ (a pair at the least similarity fails with a probability under ``MISJUDGED``)
where it is made; no other pair is written or shuffled, and no sketches are joined.

Links: a list's members are first compared with its pivot, the member whose
keys are commonest (in a group of copies, the original).  Pairs that pass are confirmed
on the full sets of shingles as text.  Links make components.  Another round
draws another pivot for each list, from its most frequent component, and compares
members of other components with it, each member with the few pivots that its
signature says are nearest; in the last, every pair of one list that is still in
two components is compared: in short lists as a row for each pair that passes, in long ones
within cells, first of signatures and then, for members that may be similar to
another, of full sets, which return no more than the links that join components.  So no link that would join two components is left
out, and the pairs within a group that is already joined are never made.

Texts are read where a pair or a member has passed; no other text is shuffled.

Null text, or one without words, has an empty set and is linked with nothing.
Rows of one doc_id are one document: if their texts differ, their classes belong together.
Repeated rows are exact copies.  A row with null doc_id takes no part and keeps
a null component.  No rows give no rows.  Extra columns are dropped.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from surfrank.llm.graph import components
from surfrank.llm.tables import broadcast_if_small, deleted, likely, settled, table, written
from surfrank.llm.text import mix, shingles, words_of
from surfrank.session import job_conf

#: Least hashes of a band's key; unrelated sets with a similarity of s share a key with a probability of s**BAND_ROWS.
BAND_ROWS = 4
#: Probability that a pair at the least similarity shares no key, and that its signatures are too different, at most.
MISSED, MISJUDGED = 5e-8, 1e-7
#: Least hashes that have two bits each in a signature of FIELDS / 32 longs.
FIELDS = 64
SIGNATURE = [f"s{k}" for k in range(FIELDS // 32)]
#: Values that are hashed in one go.
SLICE_VALUES = 1 << 15
#: Rounds with drawn pivots, and pivots of a member that are confirmed in each.
PIVOT_ROUNDS, PIVOTS_TRIED = 1, 4
#: In the last round lists up to this length make pairs; longer ones are compared in cells.
SHORT_LIST = 16
#: Members on a side of a cell of signatures, and those that are compared with the other side in one go.
CELL_MEMBERS, STRIP = 4096, 32
#: Shingles on a side of a cell, and what a document counts besides its own (it bounds the documents).
CELL_WEIGHT, CELL_BASE = 250_000, 100
#: Texts that a Python worker has at once.
BATCH_TEXTS = 1000
_LOWER = bytes(c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))


def bands(percent: int) -> int:
    """Keys of a set, so that a pair of this similarity shares none with a probability of MISSED at most."""
    return math.ceil(math.log(MISSED) / math.log(max(1e-9, 1 - (percent / 100) ** BAND_ROWS)))


def most_differing(percent: int) -> int:
    """Fields in which the signatures of a pair of this similarity differ, but for a probability of MISJUDGED."""
    differs, most, rest = (1 - percent / 100) * 3 / 4, -1, 1.0
    while rest > MISJUDGED:
        most += 1
        rest -= math.comb(FIELDS, most) * differs**most * (1 - differs) ** (FIELDS - most)
    return most


def _seeds(n: int) -> tuple[np.ndarray, np.ndarray]:
    drawn = (mix(np.arange(1, 2 * n + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)) >> np.uint64(32)).astype(np.uint32)
    return drawn[:n], drawn[n:] | np.uint32(1)


def least_hashes(values: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """The least of each of n hashes over the values (32 bits) of each set, none of them empty, as rows; a set ends where the next begins."""
    out = np.full((n, len(ends)), 0xFFFFFFFF, dtype=np.uint32)
    starts, flips, factors = np.concatenate([ends[:0], [0], ends[:-1]])[: len(ends)], *_seeds(n)
    for at in range(0, len(values), SLICE_VALUES):
        part = values[at : at + SLICE_VALUES]
        first, last = np.searchsorted(ends, at, side="right"), np.searchsorted(starts, at + len(part), side="left")
        inner, hashes = np.maximum(starts[first:last] - at, 0), np.empty_like(part)
        for k in range(n):
            np.multiply(np.bitwise_xor(part, flips[k], out=hashes), factors[k], out=hashes)
            np.minimum(out[k, first:last], np.minimum.reduceat(hashes, inner), out=out[k, first:last])
    return out


def keys_and_signatures(values: np.ndarray, ends: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The keys of each set's bands, and its signature: two bits of each of FIELDS least hashes."""
    b = bands(percent)
    least = least_hashes(values, ends, max(FIELDS, b * BAND_ROWS)).astype(np.uint64)
    keys = np.repeat(mix(np.arange(1, b + 1, dtype=np.uint64))[:, None], len(ends), axis=1)
    for k in range(BAND_ROWS):
        keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + least[k * b : (k + 1) * b])
    bits = (mix(least[:FIELDS] + np.uint64(1)) & np.uint64(3)) << (np.arange(FIELDS, dtype=np.uint64) % np.uint64(32) * np.uint64(2))[:, None]
    return keys.T.view(np.int64), np.bitwise_or.reduce(bits.reshape(FIELDS // 32, 32, len(ends)), axis=1).view(np.int64)


def _sketch(size: int, percent: int):
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b = bands(percent)
        for batch in batches:
            words, offsets = words_of(batch.column("text"), lower=True)
            n, digests, values = [], [], [np.zeros(0, dtype=np.uint32)]
            for x, y in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
                own = np.unique(shingles(words[x:y], size).view(np.int64))
                n.append(len(own))
                digests.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest())
                values.append((own >> 32).astype(np.uint32))
            n = np.array(n, dtype=np.int64)
            has = n > 0
            keys, signed = keys_and_signatures(np.concatenate(values), np.cumsum(n[has]), percent)
            ends = np.concatenate([[0], np.cumsum(has * b)])
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(keys.ravel()))
            signatures = [np.zeros(len(n), dtype=np.int64) for _ in signed]
            for all_rows, some in zip(signatures, signed):
                all_rows[has] = some
            columns = [batch.column("doc_id"), batch.column("text_key"), pa.array(n), pa.array(digests, pa.binary()), lists, *map(pa.array, signatures)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "text_key", "n", "digest", "keys", *SIGNATURE])

    return sketch


def shingle_set(text: str, size: int) -> set:
    """The full set of shingles, as words."""
    words = text.encode().translate(_LOWER).split()
    if len(words) < size:
        return {tuple(words)} if words else set()
    return set(zip(*(words[j:] for j in range(size))))


def _confirm(size: int, percent: int):
    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, known = [], (None, set())
            for a, b, x, y in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "text_a", "text_b"))):
                if known[0] != a:
                    known = (a, shingle_set(x, size))
                one, two = known[1], shingle_set(y, size)
                both = len(one & two)
                if 100 * both >= percent * (len(one) + len(two) - both):
                    out.append((a, b))
            columns = list(zip(*out)) if out else [(), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["a", "b"])

    return confirm


def _common(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all left with all right sets, by products of slices of their incidence matrices."""
    values, n = np.concatenate(left + right), [len(x) for x in left + right]
    owner = np.repeat(np.arange(len(n)), n)
    distinct, column, count = np.unique(values, return_inverse=True, return_counts=True)
    shared = count > 1  # a value of a single set adds nothing
    number = np.cumsum(shared) - 1
    keep = shared[column]
    owner, column = owner[keep], number[column[keep]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    out = np.zeros((len(left), len(right)), dtype=np.float32)
    for at in range(0, int(shared.sum()), 2048):
        a, b = np.searchsorted(column, [at, at + 2048])
        m = np.zeros((len(n), 2048), dtype=np.float32)
        m[owner[a:b], column[a:b] - at] = 1
        out += m[: len(left)] @ m[len(left) :].T
    return out


def _differing(x: str, y: str) -> str:
    """SQL for the number of fields in which two signatures differ; ``x`` and ``y`` come before their names."""
    return " + ".join(f"bit_count((({x}{s} ^ {y}{s}) | shiftrightunsigned({x}{s} ^ {y}{s}, 1)) & {0x5555555555555555}L)" for s in SIGNATURE)


def _signature_cell(percent: int):
    most = most_differing(percent)

    def cell(rows: pa.Table) -> pa.Table:
        side, node, part, n = (rows.column(c).to_numpy() for c in ("side", "node", "component", "n"))
        signature = np.stack([rows.column(s).to_numpy() for s in SIGNATURE]).view(np.uint64)
        left, right, has = np.flatnonzero(side == 0), np.flatnonzero(side == 1), np.zeros(len(side), dtype=bool)
        for at in range(0, len(left), STRIP):
            some = left[at : at + STRIP]
            flips = signature[:, some, None] ^ signature[:, None, right]
            near = np.bitwise_count((flips | flips >> np.uint64(1)) & np.uint64(0x5555555555555555)).sum(axis=0, dtype=np.uint8) <= most
            x, y = n[some][:, None], n[right][None, :]
            near &= (part[some][:, None] != part[right][None, :]) & (np.minimum(x, y) * 100 >= np.maximum(x, y) * percent)
            has[some] |= near.any(axis=1)
            has[right] |= near.any(axis=0)
        c = rows.column("c").to_numpy()[has]
        return pa.table({"c": pa.array(c, pa.int64()), "node": pa.array(node[has], pa.int64())})

    return cell


def _cell(size: int, percent: int):
    def cell(rows: pa.Table) -> pa.Table:
        side = np.array(rows.column("side").to_pylist())
        links: list[tuple[int, int]] = []
        if (side == 0).any() and (side == 1).any():
            words, offsets = words_of(rows.column("text"), lower=True)
            sets = [np.unique(shingles(words[a:b], size)) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            node, part = rows.column("node").to_pylist(), rows.column("component").to_pylist()
            left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
            both = _common([sets[i] for i in left], [sets[j] for j in right])
            n = np.array([len(x) for x in sets], dtype=np.float64)
            near = 100 * both >= percent * (n[left][:, None] + n[right][None, :] - both)
            home = {p: p for p in part}

            def root(p):
                while home[p] != p:
                    home[p] = p = home[home[p]]
                return p

            text = rows.column("text")
            for x, y in zip(*(k.tolist() for k in np.nonzero(near))):
                i, j = int(left[x]), int(right[y])
                p, q = root(part[i]), root(part[j])
                if p == q:
                    continue
                one, two = shingle_set(text[i].as_py(), size), shingle_set(text[j].as_py(), size)
                common = len(one & two)
                if 100 * common >= percent * (len(one) + len(two) - common):
                    home[p] = q
                    links.append((min(node[i], node[j]), max(node[i], node[j])))
        a, b = zip(*links) if links else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return cell


class NearDuplicates:
    """Rows of ``documents`` (doc_id, text) with n_shingles and component_id: see the module."""

    def __init__(self, documents: DataFrame, size: int, percent: int):
        self.size, self.percent = size, percent
        self.texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("text").cast("string")).alias("text_key"), F.col("text").cast("string").alias("text"))
        self.paths: list[str] = []  # tables that are done with when the links are known

    def _written(self, df: DataFrame, name: str) -> DataFrame:
        return written(df, name, self.paths)

    def _done_since(self, mark: int, keep: int = 0) -> None:
        """Deletes the tables written since ``mark`` of them were there, but for the last ``keep``."""
        done = self.paths[mark : len(self.paths) - keep]
        del self.paths[mark : len(self.paths) - keep]
        deleted(self.texts.sparkSession, done)

    def run(self) -> DataFrame:
        sketched = written(self.texts.mapInArrow(_sketch(self.size, self.percent), f"doc_id long, text_key long, n long, digest binary, keys array<long>, {', '.join(f'{s} long' for s in SIGNATURE)}"), "sketches")
        known = sketched.where("n > 0 AND doc_id IS NOT NULL")
        groups = known.groupBy("digest").agg(F.min(F.struct("doc_id", "text_key")).alias("one"), *[F.first(c).alias(c) for c in ("n", "keys", *SIGNATURE)])
        classes = self._written(groups.select("digest", "one.doc_id", "one.text_key", "n", "keys", *SIGNATURE), "classes")
        several = self._written(known.groupBy("doc_id").agg(F.min("digest").alias("lo"), F.max("digest").alias("hi")).where("lo <> hi").select("doc_id"), "several")
        self.plain = several.isEmpty()  # each doc_id has one text, and classes are numbered by doc_ids
        if self.plain:
            self.classes = classes.withColumn("node", F.col("doc_id"))
            links = self._links()
        else:
            links = self._linked_by_id(known, classes, several)
        named = self.classes.join(components(links), "node", "left").withColumn("component", F.coalesce("component", "node"))
        if not self.plain:  # numbers of classes aren't doc_ids everywhere
            least = settled(named.groupBy("component").agg(F.min("doc_id").alias("least")))
            named = named.join(least, "component").withColumn("component", F.col("least"))
        named = settled(named.select("digest", F.col("component").alias("node")))
        deleted(self.texts.sparkSession, self.paths)
        # the kept table has a row for each set, and both sides have plain exchanges: a large group of copies can be split
        rows = sketched.select("doc_id", "n", "digest").join(named, "digest", "left")
        part = F.when(F.col("n") > 0, F.col("node")).otherwise(F.col("doc_id"))
        return rows.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), part).alias("component_id"))

    def _linked_by_id(self, known: DataFrame, classes: DataFrame, several: DataFrame) -> DataFrame:
        """Links of classes of which some share a doc_id: a class whose smallest doc_id is taken gets a number below all doc_ids."""
        lowest = classes.agg(F.min("doc_id")).first()[0]
        nth = F.row_number().over(Window.partitionBy("doc_id").orderBy("digest"))  # as many as texts of a document
        node = F.when(nth == 1, F.col("doc_id")).otherwise(F.lit(lowest - 1) - F.monotonically_increasing_id())
        self.classes = self._written(classes.withColumn("node", node), "classes")
        shared = known.join(broadcast_if_small(several), "doc_id").select("doc_id", "digest").distinct().join(self.classes.select("digest", "node"), "digest")
        shared = self._written(shared.select("doc_id", "node"), "shared")
        first = shared.groupBy("doc_id").agg(F.min("node").alias("first"))
        return self._links().union(shared.join(first, "doc_id").where("node <> first").select(F.col("first").alias("a"), F.col("node").alias("b")))

    def _lists(self) -> DataFrame:
        """(value, node, n, signature, weight): the keys that a class shares with others; weight is the sum of their frequencies."""
        mark = len(self.paths)
        rows = self.classes.select("node", F.explode("keys").alias("value"))
        common = self._written(rows.groupBy("value").agg(F.count("*").alias("df")).where("df > 1"), "values")
        rows = likely(rows, common.select("value"), "value").join(common, "value")
        rows = rows.withColumn("weight", F.sum("df").over(Window.partitionBy("node")))
        lists = self._written(rows.join(self.classes.select("node", "n", *SIGNATURE), "node").select("value", "node", "n", *SIGNATURE, "weight"), "lists")
        self._done_since(mark, keep=1)
        return lists

    def _links(self) -> DataFrame:
        """Links that join all that is similar."""
        lists = self._lists()
        mark = len(self.paths)
        best = F.max(F.struct("weight", (-F.col("node")).alias("neg"), "n", *SIGNATURE)).alias("best")
        pivots = lists.groupBy("value").agg(best).select("value", (-F.col("best.neg")).alias("pivot"), *[F.col(f"best.{c}").alias(f"pivot_{c}") for c in ("n", *SIGNATURE)])
        starred = lists.join(self._written(pivots, "pivots"), "value").where("node <> pivot").where(self._alike("", "pivot_"))
        starred = starred.groupBy("node", "pivot").agg(F.count("*").alias("shared"))
        pairs = self._written(starred.select("shared", F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b"), "node"), "pairs")
        first = pairs.withColumn("r", F.row_number().over(Window.partitionBy("node").orderBy(F.desc("shared"), "a", "b"))).where("r = 1")
        tested = self._written(first.select("a", "b").distinct(), "tested")
        self._done_since(mark, keep=1)
        links = self._confirmed(tested)
        for turn in range(PIVOT_ROUNDS + 1):
            mark = len(self.paths)
            found = components(links)
            label = lists.drop("weight").join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
            split = label.groupBy("value").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("members"))
            split = self._written(split.where("lo <> hi").select("value", "members"), "split")
            if split.isEmpty():
                break
            rows = self._written(label.join(split, "value"), "open")
            if turn < PIVOT_ROUNDS:
                top = self._largest(rows, turn)
                met = rows.join(top.drop("members"), "value").where("component <> c").where(self._alike("", "other_"))
                new = met.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b"), "node", F.expr(_differing("", "other_")).alias("differing")).distinct()
            else:
                long = rows.where(F.col("members") > SHORT_LIST)
                links = settled(links.union(self._met_in_cells(long, self._written(self._largest(long, turn), "largest"))))
                new = self._pairs_of_short(rows.where(F.col("members") <= SHORT_LIST))
            passed = new.join(tested, ["a", "b"], "left_anti")
            if turn < PIVOT_ROUNDS:  # each member's most similar pivots; the others come again in the last round
                nearest = Window.partitionBy("node").orderBy("differing", "a", "b")
                passed = passed.withColumn("r", F.row_number().over(nearest)).where(F.col("r") <= PIVOTS_TRIED)
            passed = self._written(passed.select("a", "b").distinct(), "passed")
            self._done_since(mark, keep=1)
            links = settled(links.union(self._confirmed(passed)))
            tested = tested.union(passed)
        return links

    def _pairs_of_short(self, rows: DataFrame) -> DataFrame:
        """(a, b) of pairs in two components that share one of these lists and may be similar."""
        members = rows.groupBy("value").agg(F.sort_array(F.collect_list(F.struct("node", "n", "component", *SIGNATURE))).alias("m"))  # SHORT_LIST at most
        others = f"filter(slice(m, i + 2, {SHORT_LIST}), y -> y.component <> x.component AND {self._alike('x.', 'y.')})"
        pairs = F.explode(F.expr(f"flatten(transform(m, (x, i) -> transform({others}, y -> struct(x.node AS a, y.node AS b))))")).alias("p")
        return members.select(pairs).select("p.a", "p.b").distinct()

    def _largest(self, rows: DataFrame, turn: int) -> DataFrame:
        """Each list's members, its most frequent component c, and of that a pseudorandom member, another one in each turn."""
        drawn = F.min(F.struct(F.xxhash64(F.lit(turn), "value", "node").alias("h"), "node", "n", *SIGNATURE))
        per = rows.groupBy("value", "component").agg(F.count("*").alias("size"), drawn.alias("one"))
        per = per.groupBy("value").agg(F.sum("size").alias("members"), F.max(F.struct("size", "component", "one")).alias("best"))
        return per.select("value", "members", F.col("best.one.node").alias("other"), *[F.col(f"best.one.{c}").alias(f"other_{c}") for c in ("n", *SIGNATURE)], F.col("best.component").alias("c"))

    def _met_in_cells(self, rows: DataFrame, lists: DataFrame) -> DataFrame:
        """Links between components among the members of long lists, by full sets.

        Lists with the same most frequent component c are taken together.  A
        pair in two components has a member outside c; these (side 0) meet all
        members (side 1) in cells of bounded size: first by their signatures, and
        those that may be similar to another by their texts.  There a cell returns the links that
        join components, not those between components that it has joined.
        """
        mark = len(self.paths)
        members = rows.join(lists.select("value", "c"), "value").groupBy("c", "node").agg(*[F.first(x).alias(x) for x in ("component", "n", *SIGNATURE)])
        members = self._written(members, "members")
        cells = self._dealt(members, F.lit(1), CELL_MEMBERS, "n", *SIGNATURE)
        near = cells.groupBy("c", "i", "j").applyInArrow(_signature_cell(self.percent), "c long, node long").distinct()
        near = self._written(members.select("c", "node", "component", "n").join(near, ["c", "node"], "left_semi"), "near")
        both = self._dealt(near, F.col("n") + F.lit(CELL_BASE), CELL_WEIGHT).join(self._texts_of(near.select("node")), "node")
        links = settled(both.groupBy("c", "i", "j").applyInArrow(_cell(self.size, self.percent), "a long, b long"))
        self._done_since(mark)
        return links

    def _dealt(self, members: DataFrame, weight: F.Column, most: int, *more: str) -> DataFrame:
        """(c, node, component, more, i, j, side): members outside c and all of them, dealt to cells (c, i, j) with a weight of about ``most`` on a side."""
        outside = F.col("component") != F.col("c")
        parts = members.groupBy("c").agg(F.sum(F.when(outside, weight).otherwise(0)).alias("u"), F.sum(weight).alias("v"))
        parts = parts.select("c", F.ceil(F.col("u") / most).alias("us"), F.ceil(F.col("v") / most).alias("vs"))
        h = F.xxhash64(F.lit(13), "node")
        dealt = members.join(settled(parts), "c").withColumn("i", F.pmod(h, F.col("us"))).withColumn("j", F.pmod(h, F.col("vs")))
        side_0 = dealt.where(outside).select("c", "node", "component", *more, "i", F.explode(F.expr("sequence(0L, vs - 1)")).alias("j"), F.lit(0).alias("side"))
        side_1 = dealt.select("c", "node", "component", *more, F.explode(F.expr("sequence(0L, us - 1)")).alias("i"), "j", F.lit(1).alias("side"))
        return side_0.unionByName(side_1)

    def _alike(self, x: str, y: str) -> str:
        """SQL: the sets of these sizes and signatures may be similar enough."""
        return f"least({x}n, {y}n) * 100 >= greatest({x}n, {y}n) * {self.percent} AND {_differing(x, y)} <= {most_differing(self.percent)}"

    def _texts_of(self, nodes: DataFrame) -> DataFrame:
        """(node, text) of classes; of all texts, hardly any others are shuffled."""
        if self.plain:
            wanted = nodes.select(F.col("node").alias("doc_id")).distinct()
            rows = likely(self.texts, wanted, "doc_id").join(wanted, "doc_id", "left_semi")
            return self._written(rows.dropDuplicates(["doc_id"]).select(F.col("doc_id").alias("node"), "text"), "texts")
        wanted = self._written(self.classes.select("node", "doc_id", "text_key").join(nodes.distinct(), "node", "left_semi"), "wanted")
        rows = likely(self.texts, wanted.select("text_key"), "text_key")
        return self._written(rows.join(wanted, ["doc_id", "text_key"]).dropDuplicates(["node"]).select("node", "text"), "texts")

    def _confirmed(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) whose full sets of shingles are similar."""
        mark = len(self.paths)
        own = self._texts_of(pairs.select(F.explode(F.array("a", "b")).alias("node")))  # few of the texts; joins with these can split a pivot of many pairs
        text = lambda x: own.select(F.col("node").alias(x), F.col("text").alias(f"text_{x}"))
        met = pairs.select("a", "b").join(text("b"), "b").join(text("a"), "a").select("a", "b", "text_a", "text_b")
        links = settled(met.mapInArrow(_confirm(self.size, self.percent), "a long, b long"))
        self._done_since(mark)
        return links


def near_duplicates(documents: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles and component_id of each row; by default five words and 0.8."""
    settings = {"spark.sql.execution.arrow.maxRecordsPerBatch": str(BATCH_TEXTS)}
    settings["spark.sql.classic.shuffleDependency.fileCleanup.enabled"] = "true"  # every table is written or checkpointed, so a job's shuffles end with it
    with job_conf(documents.sparkSession, settings):
        return NearDuplicates(documents, size, percent).run()


def op9_minhash_near_dedup(spark, sf_dir):
    out = near_duplicates(table(spark, sf_dir, "documents"), size=2, percent=80)
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))

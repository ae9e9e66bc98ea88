"""MinHash near-duplicate detection with sequential Bayesian verification.

Signatures are cut into bands; documents that share a band are candidates. A candidate pair's signatures are compared
in batches; after each one the pair goes if the posterior probability (uniform prior) that its similarity reaches the
threshold is below the chosen miss probability. Survivors are verified on the full shingle sets.

Equal sets are collapsed first. A bucket emits no pairs of its members but two stars (smallest id, and an id picked by
hash). The members that the verified stars have left outside their bucket's largest class are compared with all of its
members, in blocks of bounded size and by signatures: each emits its most similar survivors of the pruning. What is then
still apart is verified on full sets inside the blocks; only members with a survivor take their text there, and a block
emits only links that join classes.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from chronolith.llm.text import Tables, map_in_arrow, mixed as mix, shingles, steps
from chronolith.operators.graph import components

HASHES, BANDS, BATCH = 128, 32, 16
#: Survivors that a member emits before the blocks verify on full sets, and shingles that a block of texts may hold for that.
BEST, BLOCK_SHINGLES = 2, 1_000_000
_rng = np.random.default_rng(20240229)
_XOR = _rng.integers(0, 1 << 32, HASHES, np.uint32)
_MUL = _rng.integers(0, 1 << 32, HASHES, np.uint32) | np.uint32(1)
_BAND = _rng.integers(0, 1 << 63, BANDS).astype(np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def signature(hashes: np.ndarray) -> np.ndarray:
    """MinHash values (uint32) of a set of 64-bit hashes; the set must not be empty."""
    low, out = (hashes >> np.uint64(32)).astype(np.uint32), np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(low), 2048):
        part = (low[None, i : i + 2048] ^ _XOR[:, None]) * _MUL[:, None]
        np.minimum(out, part.min(axis=1), out=out)
    return out


def band_keys(values: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band of a signature."""
    rows = values.reshape(BANDS, -1).astype(np.uint64)
    key = _BAND.copy()
    for i in range(rows.shape[1]):
        key = key * _STEP + rows[:, i]
    return mix(key).view(np.int64)


def least_matches(threshold: float, miss: float) -> list[int]:
    """For 16, 32, ... compared hashes: the least number of equal ones with P(similarity >= threshold) >= miss."""

    def reach(m: int, n: int) -> float:  # of Beta(m + 1, n - m + 1)
        return sum(comb(n + 1, j) * threshold**j * (1 - threshold) ** (n + 1 - j) for j in range(m + 1))

    return [next((m for m in range(n + 1) if reach(m, n) >= miss), n + 1) for n in range(BATCH, HASHES + 1, BATCH)]


def likely(left: np.ndarray, right: np.ndarray, least: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Indexes of the rows of two signature matrices that outlive every batch, and how many hashes are equal there."""
    alive, matches = np.arange(len(left)), np.zeros(len(left), np.int32)
    for i, need in enumerate(least):
        part = slice(i * BATCH, (i + 1) * BATCH)
        matches = matches + (left[alive, part] == right[alive, part]).sum(axis=1, dtype=np.int32)
        stay = matches >= need
        alive, matches = alive[stay], matches[stay]
    return alive, matches


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, set_hash, sig (16 bits of each MinHash value), bands; the last three are null for an empty set."""
    schema = "doc_id long, n_shingles long, set_hash binary, sig binary, bands array<long>"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            size, same, sig, bands = [], [], [], []
            for text in batch.column("text").to_pylist():
                s = shingles(text)
                size.append(len(s))
                v = signature(s) if len(s) else None
                same.append(None if v is None else xxhash.xxh3_128_digest(s.tobytes()))
                sig.append(None if v is None else v.astype(np.uint16).tobytes())
                bands.append(None if v is None else band_keys(v))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(size, pa.int64()), pa.array(same, pa.binary()), pa.array(sig, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                names=["doc_id", "n_shingles", "set_hash", "sig", "bands"],
            )

    return map_in_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), run, schema)


def pruned(pairs: DataFrame, sigs: DataFrame, threshold: float, miss: float) -> DataFrame:
    """Of pairs (a, b), those that the sequential comparison of signatures leaves."""
    least = least_matches(threshold, miss)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, HASHES) for c in ("sig_a", "sig_b"))
                yield batch.select(["a", "b"]).take(pa.array(likely(x, y, least)[0]))

    both = pairs.join(sigs.select(F.col("doc_id").alias("a"), F.col("sig").alias("sig_a")), "a").join(sigs.select(F.col("doc_id").alias("b"), F.col("sig").alias("sig_b")), "b")
    return map_in_arrow(both.select("a", "b", "sig_a", "sig_b"), run, "a long, b long")


def verified(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Of pairs (a, b), those with 100 * intersection >= percent * union on the full shingle sets."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, left = None, None
        for batch in steps(batches, "text_b"):
            stay, texts_a = [], batch.column("text_a")
            for i, (a, y) in enumerate(zip(batch.column("a").to_pylist(), batch.column("text_b").to_pylist(), strict=True)):
                if a != last or left is None:
                    last, left = a, shingles(texts_a[i].as_py())
                right = shingles(y)
                both = len(np.intersect1d(left, right, assume_unique=True))
                if 100 * both >= percent * (len(left) + len(right) - both):
                    stay.append(i)
            yield batch.select(["a", "b"]).take(pa.array(stay, pa.int64()))

    t = texts.select("doc_id", "text")
    both = pairs.join(t.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b").join(t.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
    return map_in_arrow(both.select("a", "b", "text_a", "text_b"), run, "a long, b long")


def apart(members: DataFrame, classes: DataFrame, reps: DataFrame) -> DataFrame:
    """Members (key, doc_id) of buckets with several classes: with class, sketch and ``out`` (outside the bucket's largest class), and the bucket's sums."""
    labelled = members.join(classes.withColumnRenamed("id", "doc_id"), "doc_id", "left").select("key", "doc_id", F.coalesce("component", "doc_id").alias("class")).join(reps, "doc_id")
    sizes = labelled.groupBy("key", "class").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("total"))
    top = sizes.groupBy("key").agg(F.max(F.struct("n", -F.col("class"), F.col("class").alias("c"), "total")).alias("t"), F.sum("n").alias("n"), F.sum("total").alias("total"), F.count("*").alias("k")).where("k > 1")
    top = top.select("key", F.col("t.c").alias("top"), "n", "total", (F.col("n") - F.col("t.n")).alias("n_out"), (F.col("total") - F.col("t.total")).alias("total_out"))
    return labelled.join(top, "key").withColumn("out", F.col("class") != F.col("top")).drop("top")


def dealt(rows: DataFrame, block: int, shingles_a_block: int | None = None) -> DataFrame:
    """Each bucket's members outside the largest class against all of its members, as pairs of blocks (key, r, s); a member's ``role`` tells its side.

    A side is cut into blocks of about ``block`` members, and of ``shingles_a_block`` if given, by a hash of the id. So a
    member is copied once for each block of the other side: a bucket with few members outside is read once.
    """
    many = lambda n, total: F.greatest(F.ceil(F.col(n) / block), F.ceil(F.col(total) / shingles_a_block) if shingles_a_block else F.lit(1)).cast("int")
    rows = rows.withColumns({"_s": many("n", "total"), "_r": many("n_out", "total_out"), "_h": F.xxhash64("doc_id")})
    mine = lambda parts: F.pmod(F.col("_h"), F.col(parts)).cast("int")
    every = F.transform(F.sequence(F.lit(0), F.col("_r") - 1), lambda r: F.struct(F.lit(False).alias("role"), r.alias("r"), mine("_s").alias("s")))
    outer = F.transform(F.sequence(F.lit(0), F.col("_s") - 1), lambda s: F.struct(F.lit(True).alias("role"), mine("_r").alias("r"), s.alias("s")))
    copies = rows.withColumn("_c", F.explode(F.when(F.col("out"), F.concat(every, outer)).otherwise(every)))
    return copies.select("_c.*", *[c for c in rows.columns if c not in ("_s", "_r", "_h", "n", "total", "n_out", "total_out")])


class Block:
    """One pair of blocks: ``ask`` are members outside the largest class, ``all_`` members of the bucket; both as places in the group."""

    def __init__(self, group: pa.Table, least: list[int]):
        self.group, self.least, self.key = group, least, group.column("key")[0].as_py()
        self.ids, role = group.column("doc_id").to_numpy(), group.column("role").to_numpy()
        self.ask, self.all_, self.out = np.flatnonzero(role), np.flatnonzero(~role), group.column("out").to_numpy()
        self.cls = np.unique(group.column("class").to_numpy(), return_inverse=True)[1]
        self.sig = np.frombuffer(b"".join(group.column("sig").to_pylist()), np.uint16).reshape(-1, HASHES)
        self.bands = np.array(group.column("bands").combine_chunks().flatten()).reshape(-1, BANDS)
        self.band = int(np.flatnonzero(self.bands[0] == self.key)[0])

    def candidates(self, i: int) -> np.ndarray:
        """Places of members of other classes that outlive the pruning, most similar first.

        A pair is left to the first band that it shares; of two members that are both outside, the one with the smaller id asks.
        """
        j = self.all_
        j = j[(self.cls[j] != self.cls[i]) & (~self.out[j] | (self.ids[j] > self.ids[i]))]
        j = j[(self.bands[j] == self.bands[i]).argmax(axis=1) == self.band]
        alive, equal = likely(np.broadcast_to(self.sig[i], (len(j), HASHES)), self.sig[j], self.least)
        return j[alive[np.argsort(-equal, kind="stable")]]

    def pairs(self, found: list[tuple[int, int]]) -> pa.Table:
        both = np.unique(np.sort(self.ids[np.array(found, np.int64).reshape(-1, 2)], axis=1), axis=0)
        return pa.table({"key": np.full(len(both), self.key, np.int64), "a": both[:, 0], "b": both[:, 1]})


def blocks_compared(rows: DataFrame, threshold: float, miss: float, block: int) -> DataFrame:
    """key, a, b: of each member outside its bucket's largest class, the ``BEST`` pairs with other classes that outlive the pruning."""
    least = least_matches(threshold, miss)

    def run(group: pa.Table) -> pa.Table:
        own = Block(group, least)
        return own.pairs([(i, j) for i in own.ask for j in own.candidates(i)[:BEST]])

    return dealt(rows.drop("n_shingles"), block).groupBy("key", "r", "s").applyInArrow(run, "key long, a long, b long")


def blocks_left(rows: DataFrame, threshold: float, miss: float, block: int) -> DataFrame:
    """The members of each pair of blocks that have a survivor of the pruning in another class; blocks are small enough to take their texts."""
    least = least_matches(threshold, miss)

    def run(group: pa.Table) -> pa.Table:
        own = Block(group, least)
        stay = np.zeros(len(own.ids), bool)
        for i in own.ask:
            j = own.candidates(i)
            stay[j], stay[i] = True, stay[i] or len(j) > 0
        return group.filter(pa.array(stay))

    found = dealt(rows, block, BLOCK_SHINGLES)
    return found.groupBy("key", "r", "s").applyInArrow(run, found.schema)


def blocks_verified(rows: DataFrame, threshold: float, miss: float) -> DataFrame:
    """key, a, b: links on the full sets of ``text`` that join the classes of each pair of blocks."""
    least, percent = least_matches(threshold, miss), round(threshold * 100)

    def run(group: pa.Table) -> pa.Table:
        own = Block(group, least)
        texts = group.column("text")
        sets = [shingles(t.as_py()) for t in texts]
        size = np.array([len(s) for s in sets])
        found: list[tuple[int, int]] = []
        for i in own.ask:
            left = own.candidates(i)
            while len(left):
                many = max(1, int(np.searchsorted(np.cumsum(size[left]), 1 << 18)))
                now, left = left[:many], left[many:]
                flat = np.concatenate([sets[j] for j in now])
                at = np.minimum(np.searchsorted(sets[i], flat), size[i] - 1)
                both = np.add.reduceat((sets[i][at] == flat).astype(np.int64), np.concatenate([[0], np.cumsum(size[now])[:-1]]))
                for j in now[100 * both >= percent * (size[now] + size[i] - both)]:
                    if own.cls[i] != own.cls[j]:
                        found.append((i, j))
                        own.cls[own.cls == own.cls[j]] = own.cls[i]
                left = left[own.cls[left] != own.cls[i]]
        return own.pairs(found)

    return rows.groupBy("key", "r", "s").applyInArrow(run, "key long, a long, b long")


def near_duplicates(docs: DataFrame, threshold: float = 0.75, miss: float = 1e-6, block: int = 2000) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each row of ``docs`` (doc_id, text; further columns are not read).

    Null or blank text: an empty set, linked with nothing. Null doc_id: component_id is null and the row is kept.
    Rows that repeat a doc_id share its class; of their different texts, that with the largest set is the one compared by
    signatures. An empty table gives no rows. Candidates are missed with probability (1 - s**4)**32 at similarity s (5e-6
    at 0.75) and by pruning with ``miss`` at each of eight batches.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    percent, at = round(threshold * 100), Tables(docs.sparkSession)
    sketch = at.keep(sketches(docs), "sketches")
    sets = sketch.where("doc_id is not null and n_shingles > 0")
    # one representative for each set; only sets that occur more than once are written
    copies = at.keep(sets.groupBy("set_hash").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n")).where("n > 1").select("set_hash", "rep"), "copies")
    largest = F.max_by(F.struct("n_shingles", "sig", "bands"), F.struct("n_shingles", "set_hash")).alias("x")
    reps = sets.join(copies, "set_hash", "left").where(F.coalesce("rep", "doc_id") == F.col("doc_id"))
    reps = at.keep(reps.groupBy("doc_id").agg(largest).select("doc_id", "x.*"), "reps")
    banded = reps.select("doc_id", F.explode("bands").alias("key"))
    shared = at.keep(
        banded.groupBy("key").agg(F.min("doc_id").alias("first"), F.min(F.struct(F.xxhash64("key", "doc_id").alias("h"), "doc_id"))["doc_id"].alias("other"), F.count("*").alias("n")).where("n > 1"), "buckets"
    )
    members = at.keep(banded.join(shared, "key"), "members")
    star = members.select("doc_id", F.explode(F.array_distinct(F.array("first", "other"))).alias("hub")).where("doc_id <> hub")
    star = star.select(F.least("doc_id", "hub").alias("a"), F.greatest("doc_id", "hub").alias("b")).distinct()
    likely_ = at.keep(pruned(star, reps, threshold, miss), "likely")
    edges = at.keep(verified(likely_, docs, percent), "links")
    at.drop(shared, likely_)
    classes = at.keep(components(edges, "a", "b"), "classes")
    # what the stars left apart
    rest = at.keep(apart(members.where("n > 2").select("key", "doc_id"), classes, reps), "apart")
    found = at.keep(blocks_compared(rest, threshold, miss, block), "likely")
    at.drop(rest)
    if not found.isEmpty():
        edges = at.keep(edges.unionByName(verified(found.select("a", "b").distinct(), docs, percent)), "links")
        classes = at.keep(components(edges, "a", "b"), "classes")
        again = members.join(found.select("key").distinct(), "key", "left_semi").select("key", "doc_id")
        left = at.keep(blocks_left(apart(again, classes, reps), threshold, miss, block), "left")
        links = at.keep(blocks_verified(left.join(docs, "doc_id"), threshold, miss).select("a", "b").distinct(), "links")
        at.drop(left)
        if not links.isEmpty():
            classes = at.keep(components(edges.unionByName(links), "a", "b"), "classes")
    at.drop(members, found, reps, edges)
    by_rep = classes.withColumnRenamed("id", "rep")
    out = sketch.select("doc_id", "n_shingles", "set_hash").join(copies, "set_hash", "left").withColumn("rep", F.coalesce("rep", F.when(F.col("n_shingles") > 0, F.col("doc_id"))))
    out = out.join(by_rep, "rep", "left").withColumn("component_id", F.coalesce("component", "rep", "doc_id"))
    return out.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"), F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))

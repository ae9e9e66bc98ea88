"""Conversation repair at least cost by a parallel Viterbi search.

Four states follow the roles that have been written: none, a system turn, a user turn, an assistant turn. A conversation's
rows are cut into chunks. Each chunk runs backward from four speculative cost vectors, from which any vector of costs to go
can be combined; where its four results differ only by constants, the chunk forgets what follows it, and its result is
known up to a constant. Chunks that don't are fixed up in passes: each takes on the results of the chunk that it points
to, and points as far as that one, until its results differ only by constants too or the conversation's end is met. So the
passes grow with the logarithm of the longest stretch that does not converge. What each chunk gets from its neighbour is
stitched to costs to go of every row, up to a constant for each chunk; they drive the forward trace, which takes the least
letter of those that keep the cost.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from chronolith.llm.order import numbered
from chronolith.llm.text import keep, map_in_arrow

DELETE, INSERT, REROLE, TRUNCATED = 4, 3, 3, 3
NONE, SYSTEM, USER, ASSISTANT = range(4)
#: The state after a written turn of the only role that may be inserted or given, by state.
NEXT = (USER, USER, ASSISTANT, USER)
GIVEN = ("user", "user", "assistant", "user")
#: Costs to go at the end of a conversation.
END = np.array([0, 2 * INSERT, INSERT, 0], np.int64)
#: v[i] <= BOUNDS[i][j] + v[j] for all costs to go v: every such v is combined from the columns, which are the speculative vectors.
BOUNDS = np.array([[0, 0, 3, 0], [7, 0, 3, 6], [7, 3, 0, 3], [4, 0, 3, 0]], np.int64)
CLEAN, BLANK, DUPLICATE, CUT = range(4)
_SPACE = r"\x20\x09-\x0D"


def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and copy of the rows after the stated damage. Null roles and texts, and nulls in the digest's text, are one space."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    hit = F.crc32(F.encode(F.concat(part("conv_id"), F.lit(":"), part("turn")), "utf-8")) % 20
    text = F.when(hit == 1, F.lit("")).when(hit == 2, F.translate(part("text"), ".!?", "")).otherwise(part("text"))
    copies = F.explode(F.when(hit == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")
    return rows.where(hit != 0).select("conv_id", F.col("turn").cast("long").alias("turn"), F.when(hit == 4, F.lit("user")).otherwise(part("role")).alias("role"), text.alias("text"), copies)


def coded(rows: DataFrame) -> DataFrame:
    """The rows (conv_id, turn, role, text and further columns) with ``pos``, their place in the order of conversations and turns, and ``code``: the role's class plus 4 times the first fault.

    Nulls come first; rows of one turn follow role and text. A row is a duplicate if an earlier row of its conversation has its
    role and text: the earliest place of each is found by an aggregation, so a text that fills a conversation is no hot group.
    """
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "text")]
    placed = numbered(rows, order, "turns")
    firsts = placed.groupBy("conv_id", "role", F.sha2("text", 256).alias("_d")).agg(F.min("pos").alias("pos")).select("pos", F.lit(True).alias("_first"))
    bare = F.regexp_replace("text", f"[{_SPACE}]+\\z", "")
    fault = F.when(~F.col("text").rlike(f"[^{_SPACE}]"), BLANK).when(F.col("_first").isNull(), DUPLICATE).when(~F.substring(bare, -1, 1).isin(".", "!", "?"), CUT).otherwise(CLEAN)
    first = F.substring("role", 1, 1)
    kind = F.when(first == "s", SYSTEM).when(first == "u", USER).when(first == "a", ASSISTANT).otherwise(NONE)
    return placed.join(firsts, "pos", "left").withColumn("code", (kind + 4 * fault).cast("tinyint")).drop("_first")


def back(code: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Costs to go before rows of these codes. after: costs to go after them; states are its last axis, rows its first."""
    extra = (..., *[None] * (after.ndim - 2))
    kind, fault = (code & 3)[extra], (code >> 2)[extra]
    late, bound = np.where(fault == CUT, TRUNCATED, 0), (fault == BLANK) | (fault == DUPLICATE)
    out = after + DELETE
    for q in range(4):
        given = after[..., NEXT[q]] + late
        best = np.where(kind == NEXT[q], given, given + REROLE)  # classes and states have the same numbers
        if q == NONE:
            best = np.where(kind == SYSTEM, np.minimum(best, after[..., SYSTEM] + late), best)
        out[..., q] = np.where(bound, out[..., q], np.minimum(out[..., q], best))
    user, assistant = out[..., USER].copy(), out[..., ASSISTANT].copy()
    out[..., USER] = np.minimum(user, assistant + INSERT)
    out[..., ASSISTANT] = np.minimum(assistant, user + INSERT)
    for q in (NONE, SYSTEM):
        out[..., q] = np.minimum(out[..., q], out[..., USER] + INSERT)
    return out


def _walk(codes: list[np.ndarray], after: np.ndarray) -> Iterator[tuple[np.ndarray, int, np.ndarray, np.ndarray]]:
    """Rows of all chunks from their ends on, side by side: (chunks, rows from the end, costs after, costs before). after is updated."""
    size = np.array([len(c) for c in codes])
    for k in range(int(size.max(initial=0))):
        live = np.flatnonzero(size > k)
        code = np.fromiter((codes[i][size[i] - 1 - k] for i in live), np.int64, len(live))
        ends = after[live]
        after[live] = back(code, ends)
        yield live, k, ends, after[live]


def _codes(batch: pa.RecordBatch, name: str) -> list[np.ndarray]:
    column = batch.column(name)
    flat, offsets = column.flatten().to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    return [flat[a:b] for a, b in zip(offsets - offsets[0], offsets[1:] - offsets[0], strict=False)]


def _speculated(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        after = np.repeat(BOUNDS.T[None], batch.num_rows, axis=0)
        for _ in _walk(_codes(batch, "codes"), after):
            pass
        after -= after.min(axis=(1, 2), keepdims=True)
        # a row for each state, a column for each speculative vector
        flat = pa.array(after.transpose(0, 2, 1).reshape(-1))
        made = pa.ListArray.from_arrays(pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * 16), flat)
        yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("block"), made], names=["conv_id", "block", "m"])


def _product(a: Column, b: Column) -> Column:
    """Least sums over the state between; less their least, as constants don't matter."""
    each = [F.least(*[a[4 * q + k] + b[4 * k + j] for k in range(4)]) for q in range(4) for j in range(4)]
    return F.transform(F.array(*each), lambda x: x - F.least(*each))


def _converged(m: Column) -> Column:
    """Whether the results of the four vectors differ only by constants."""
    out = F.lit(True)
    for q in range(1, 4):
        for j in range(1, 4):
            out = out & (m[4 * q + j] - m[4 * q] == m[j] - m[0])
    return out


def _fixed(chunks: DataFrame) -> DataFrame:
    """conv_id, block, m: each chunk's costs to go at its start, up to a constant, in any column of m. chunks: conv_id, block, m of the speculative vectors."""
    end = F.array(*[F.lit(int(x)) for x in END.repeat(4)])
    state = keep(chunks.withColumn("next", F.when(~_converged(F.col("m")), F.col("block") + 1)), "speculated")
    while not state.where("next is not null").isEmpty():
        known = state.select(F.col("conv_id").alias("_c"), F.col("block").alias("_b"), F.col("m").alias("_m"), F.col("next").alias("_n"))
        met = state.join(known, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("next") == F.col("_b")), "left")
        m = F.when(F.col("next").isNull(), F.col("m")).when(F.col("_b").isNull(), _product(F.col("m"), end)).otherwise(_product(F.col("m"), F.col("_m")))
        met = met.select("conv_id", "block", m.alias("m"), F.when(F.col("next").isNotNull(), F.col("_n")).alias("_n"))
        state = keep(met.select("conv_id", "block", "m", F.when(~_converged(F.col("m")), F.col("_n")).alias("next")), "fixed_up")
    return state.drop("next")


def _stitched(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """pos and the eight costs before and after each row, less the least one after it."""
    for batch in batches:
        codes, places = _codes(batch, "codes"), _codes(batch, "places")
        after = np.stack([np.asarray(x, np.int64) for x in batch.column("ends").to_pylist()])
        pos, costs = [], []
        for live, k, ends, starts in _walk(codes, after):
            pos.append(np.fromiter((places[i][len(places[i]) - 1 - k] for i in live), np.int64, len(live)))
            costs.append((np.concatenate((starts, ends), axis=1) - ends.min(axis=1, keepdims=True)).astype(np.uint8))
        flat = np.concatenate(costs).reshape(-1)
        binary = pa.Array.from_buffers(pa.binary(), len(flat) // 8, [None, pa.py_buffer(np.arange(len(flat) // 8 + 1, dtype=np.int32) * 8), pa.py_buffer(flat)])
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(pos)), binary], names=["pos", "costs"])


def costs_to_go(rows: DataFrame, chunk: int) -> DataFrame:
    """pos, costs (binary: four costs before and four after the row, up to a constant) of the rows that ``coded`` gives."""
    chunks = rows.groupBy("conv_id", F.floor(F.col("pos") / chunk).alias("block")).agg(F.array_sort(F.collect_list(F.struct("pos", "code"))).alias("x"))  # at most ``chunk`` rows each
    chunks = keep(chunks.select("conv_id", "block", F.col("x.pos").alias("places"), F.col("x.code").alias("codes")), "chunks")
    key = chunks.schema["conv_id"]
    schema = StructType([key, chunks.schema["block"]]).add("m", ArrayType(LongType()))
    fixed = _fixed(map_in_arrow(chunks.select("conv_id", "block", "codes"), _speculated, schema))
    ends = fixed.select(F.col("conv_id").alias("_c"), (F.col("block") - 1).alias("_b"), F.transform(F.sequence(F.lit(0), F.lit(3)), lambda q: F.element_at("m", 4 * q + 1)).alias("ends"))
    last = F.array(*[F.lit(int(x)) for x in END])
    met = chunks.join(ends, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("block") == F.col("_b")), "left").select("places", "codes", F.coalesce("ends", last).alias("ends"))
    return map_in_arrow(met, _stitched, "pos long, costs binary")


class Trace:
    """One conversation's repair, row by row: counts, the least audit and the digest of what it leaves."""

    def __init__(self):
        self.counts, self.illegal, self.cost, self.audit, self.state = [0, 0, 0, 0], 0, 0, [], NONE
        self.before, self.turns, self.low, self.high, self.sha, self.any = None, 0, None, None, hashlib.sha256(), False

    def write(self, role: str, text: str) -> None:
        self.sha.update((("\n" if self.any else "") + role + ":").encode())
        self.sha.update(text.encode("utf-8", "surrogatepass"))
        self.any = True

    def insert(self) -> None:
        self.write(GIVEN[self.state], "")
        self.audit.append("I")
        self.cost, self.state = self.cost + INSERT, NEXT[self.state]

    def row(self, turn: int | None, role: str, text: str, code: int, costs: bytes) -> None:
        kind, fault = code & 3, code >> 2
        self.counts[fault] += 1
        if self.before is not None and self.before + role[:1] not in ("su", "ua", "au"):
            self.illegal += 1
        self.before = role[:1]
        if turn is not None and turn != self.high:
            self.turns, self.low, self.high = self.turns + 1, turn if self.low is None else self.low, turn
        late = TRUNCATED if fault == CUT else 0
        while True:  # D, I, K, R: the first that keeps the cost is the least letter
            q = self.state
            to, target = costs[q], NEXT[q]
            if DELETE + costs[4 + q] == to:
                self.audit.append("D")
                self.cost += DELETE
                return
            if INSERT + costs[target] == to:
                self.insert()
                continue
            own = SYSTEM if q == NONE and kind == SYSTEM else target
            if kind == own and late + costs[4 + own] == to:
                self.write(role, text)
                self.audit.append("K")
                self.cost, self.state = self.cost + late, own
                return
            self.write(GIVEN[q], text)
            self.audit.append("R")
            self.cost, self.state = self.cost + late + REROLE, target
            return

    def end(self) -> tuple:
        while END[self.state]:
            self.insert()
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (gaps, *self.counts[BLANK : CUT + 1], self.illegal, self.cost, "".join(self.audit), self.sha.hexdigest())


def _traced(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each conversation; its rows are consecutive and begin with the one that has no place."""
    now, trace, done = None, None, []

    def out() -> pa.RecordBatch:
        columns = list(zip(*done, strict=True))
        types = [key, *[pa.int64()] * 6, pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(columns, types, strict=True)], names=["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"])

    for batch in batches:
        key = batch.schema.field("conv_id").type
        for conv, pos, *row in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "pos", "turn", "role", "text", "code", "costs")), strict=True):
            if pos < 0:
                if trace:
                    done.append((now, *trace.end()))
                now, trace = conv, Trace()
            else:
                trace.row(*row)
        if done:
            yield out()
            done.clear()
    if trace:
        done.append((now, *trace.end()))
        yield out()


def repaired(conversations: DataFrame, chunk: int = 256, damage: bool = True) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of each conversation of ``conversations`` (conv_id, turn, role, text).

    With ``damage`` the rows are damaged first. Nulls in role and text are one space; rows without a turn come first and count
    in no gap; rows without a conv_id are one conversation; rows of one turn follow role and text; repeated rows are
    duplicates. Empty texts are blank, long ones go through whole, in batches of bounded size. Further columns are left out,
    whatever their names. A conversation of which the damage leaves no row has zeros, an empty audit and the digest of nothing;
    an empty table gives no rows. Of equally cheap repairs the one with the ASCII-least audit is taken. The search is cut into
    chunks of ``chunk`` places; only the last pass, a digest of each conversation's text in order, reads a conversation in one
    task, as a stream.
    """
    base = conversations.select("conv_id", "turn", "role", "text")
    rows = damaged(base) if damage else base.select("conv_id", F.col("turn").cast("long").alias("turn"), *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")])
    rows = keep(coded(rows), "coded")
    costs = costs_to_go(rows.select("conv_id", "pos", "code"), chunk)
    whole = rows.join(costs, "pos").select("conv_id", "pos", "turn", "role", "text", F.col("code").cast("int").alias("code"), "costs")
    first = base.select("conv_id").distinct().select("conv_id", F.lit(-1).cast("long").alias("pos"), F.lit(None).cast("long").alias("turn"), F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"), F.lit(None).cast("int").alias("code"), F.lit(None).cast("binary").alias("costs"))
    stream = whole.unionByName(first).repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "pos")
    numbers = [StructField(c, LongType()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return map_in_arrow(stream, _traced, StructType([base.schema["conv_id"], *numbers]).add("audit", "string").add("repaired_sha256", "string"))

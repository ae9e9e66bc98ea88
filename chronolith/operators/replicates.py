"""Ratings of many bootstrap replicates at once: one system of equations with many right-hand sides and weights.

A node's row holds an array of all replicates' values, an edge's row an array of its weights in them. So one join and one
aggregation a step serve all replicates, and the step sizes are arrays too. Arrays are multiplied and added in numpy, batch
by batch; sums of a batch go to the nodes' tasks, where they are added up as a sorted stream, so no node's edges meet at once.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructField, StructType

from chronolith.operators import bootstrap as B
from chronolith.operators.windows import running_counts


@contextmanager
def _files_dropped(spark: SparkSession) -> Iterator[None]:
    """Inside, a query's shuffle files go when it has ended; the setting is restored."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def kept(df: DataFrame, tag: str, **options: str) -> DataFrame:
    """``df`` written (with Parquet ``options``) to the session's checkpoint folder and read again: its size is known to the planner, and lost executors cost nothing.

    What was shuffled for it goes at once, the table itself with ``dropped``.
    """
    spark = df.sparkSession
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = f"{root}/replicates/{uuid.uuid4().hex}-{tag}"
    with _files_dropped(spark):
        df.write.options(**options).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.kept_at = path
    return out


def dropped(*tables: DataFrame) -> None:
    """Deletes ``kept`` tables, which nothing may read any more."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.kept_at)
        path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def octets(batch: pa.RecordBatch, name: str) -> np.ndarray:
    """The bytes of a binary column, row after row."""
    column = batch.column(name)
    if not len(column):
        return np.empty(0, np.uint8)
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]


def binaries(data: np.ndarray, width: int) -> pa.Array:
    """A binary column whose rows are ``width`` bytes of ``data`` each."""
    flat = np.ascontiguousarray(data).reshape(-1).view(np.uint8)
    n = len(flat) // width
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(np.arange(n + 1, dtype=np.int32) * np.int32(width)), pa.py_buffer(flat)])


def packed(rows: np.ndarray) -> pa.Array:
    """Rows of doubles as their bytes: Spark passes them on as they are, where an array is taken apart value by value."""
    return binaries(rows.astype(float, copy=False), 8 * rows.shape[1])


def matrix(batch: pa.RecordBatch, name: str, size: int) -> np.ndarray:
    """A column of arrays, or of their bytes, all of which have ``size`` values, as rows of a matrix."""
    if pa.types.is_binary(batch.schema.field(name).type):
        return np.frombuffer(octets(batch, name).tobytes(), float).reshape(-1, size)  # a copy lies at a double's address
    return batch.column(name).flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def listed(rows: np.ndarray, kind: pa.DataType | None = None) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]), pa.array(np.ascontiguousarray(rows).reshape(-1), kind or pa.float64()))


def _runs(batch: pa.RecordBatch, keys: list[str]) -> np.ndarray:
    """Where a key differs from the row before."""
    new = np.zeros(batch.num_rows, bool)
    new[:1] = True
    for k in keys:
        column = batch.column(k).to_numpy(zero_copy_only=False)
        new[1:] |= column[1:] != column[:-1]
    return np.flatnonzero(new)


def _added(batches: Iterable[pa.RecordBatch], keys: list[str], values: list[str], size: int) -> Iterator[pa.RecordBatch]:
    """Sums over neighbouring rows of equal keys, inside each batch."""
    for batch in batches:
        if batch.num_rows:
            starts = _runs(batch, keys)
            sums = [(packed if pa.types.is_binary(batch.schema.field(v).type) else listed)(np.add.reduceat(matrix(batch, v, size), starts, axis=0)) for v in values]
            yield pa.RecordBatch.from_arrays([*[batch.column(k).take(pa.array(starts)) for k in keys], *sums], names=[*keys, *values])


def vector_sums(df: DataFrame, keys: list[str], values: list[str], size: int) -> DataFrame:
    """keys (numbers or strings without nulls) and the element-wise sums of the columns ``values``, arrays of ``size`` doubles or their bytes."""
    schema = StructType([*[df.schema[k] for k in keys], *[df.schema[v] for v in values]])

    def final(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in _added(batches, keys, values, size):
            if last is not None:
                both = pa.Table.from_batches([last, batch.cast(last.schema)]).combine_chunks()
                batch = next(_added(both.to_batches(), keys, values, size))
            if batch.num_rows > 1:
                yield batch.slice(0, batch.num_rows - 1)
            last = batch.slice(batch.num_rows - 1)
        if last is not None:
            yield last

    rows = df.select(*keys, *values)
    part = rows.mapInArrow(lambda batches: _added(batches, keys, values, size), schema)
    return part.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(final, schema)


def copies(rows: DataFrame, strata: list[str], order: list[str], replicates: int, seed: int = 7, name: str = "all") -> DataFrame:
    """The rows with ``copies``, how often each replicate has drawn them: as many draws as rows inside each stratum, with replacement.

    Rows must differ in ``strata`` and ``order``. Without strata rows are numbered by ranges, not in one task.
    """
    key = F.struct(*order)
    counts = running_counts(rows.withColumn("_key", key), strata, "_key")
    numbered = kept(rows.withColumn("_key", key).join(counts.select(*strata, "_key", F.col("before").alias("_k"), F.col("total").alias("_n")), [*strata, "_key"]).drop("_key"), "numbered")
    stratum = F.concat_ws("|", *[F.col(c).cast("string") for c in strata]) if strata else F.lit(name)
    drawn = numbered.select(*strata, F.col("_k").alias("_slot"), "_n").withColumn("_r", F.explode(F.sequence(F.lit(0), F.lit(replicates - 1))))
    picked = drawn.select(*strata, "_r", B.draw(seed, F.col("_r"), stratum, F.col("_slot"), F.col("_n")).alias("_k"))
    each = picked.groupBy(*strata, "_k", "_r").agg(F.count("*").cast("double").alias("_c")).groupBy(*strata, "_k").agg(F.collect_list(F.struct("_r", "_c")).alias("_x"))  # at most a struct for each replicate
    joined = numbered.drop("_n").join(each, [*strata, "_k"]).drop("_k")
    schema = StructType([*[f for f in joined.schema if f.name != "_x"], *StructType.fromDDL("copies array<double>")])

    def spread(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("_x")
            out, flat = np.zeros((batch.num_rows, replicates)), column.flatten()
            row = np.repeat(np.arange(batch.num_rows), np.diff(column.offsets.to_numpy()))
            out[row, flat.field("_r").to_numpy()] = flat.field("_c").to_numpy()
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in schema.names[:-1]], listed(out)], names=schema.names)

    return joined.mapInArrow(spread, schema)


_STATE = ("n", "x", "r", "u", "p", "q", "v")


def _stepped(change: Callable[[dict[str, np.ndarray]], None], size: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                values = {c: matrix(batch, c, size) for c in _STATE}
                change(values)
                yield pa.RecordBatch.from_arrays([batch.column("i"), *[packed(values[c]) for c in _STATE]], names=["i", *_STATE])

    return run


def _conjugate(totals: DataFrame, pulled: Callable[[DataFrame], DataFrame], replicates: int, prior: np.ndarray | float, tolerance: float, limit: int) -> DataFrame:
    """i, ratings, weight of (diag(n + prior) - W) x = r for ``totals`` (i, n, r); ``pulled`` gives i and s = W u of a state. A state's vectors are bytes."""
    zeros = F.lit(bytes(8 * replicates))
    schema = StructType([totals.schema["i"], *StructType.fromDDL(", ".join(f"{c} binary" for c in _STATE))])

    def times(state: DataFrame, change: Callable[[dict[str, np.ndarray]], None]) -> DataFrame:
        """The state after ``change``, with v = (diag(n + prior) - W) u."""
        state = state.mapInArrow(_stepped(change, replicates), schema)  # made anew where it is read: less than writing it

        def less(values: dict[str, np.ndarray]) -> None:
            values["v"] = (values["n"] + prior) * values["u"] - values["v"]

        return kept(state.drop("v").join(pulled(state).withColumnRenamed("s", "v"), "i").select("i", *_STATE).mapInArrow(_stepped(less, replicates), schema), "times")

    def dots(state: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            ru, uv, top = np.zeros(replicates), np.zeros(replicates), np.zeros(replicates)
            for batch in batches:
                r, u, v = (matrix(batch, c, replicates) for c in "ruv")
                ru, uv, top = ru + (r * u).sum(axis=0), uv + (u * v).sum(axis=0), np.maximum(top, np.abs(u).max(axis=0, initial=0))
            yield pa.RecordBatch.from_arrays([listed(x[None]) for x in (ru, uv, top)], names=["ru", "uv", "top"])

        found = state.select("r", "u", "v").mapInArrow(run, "ru array<double>, uv array<double>, top array<double>").collect()  # a row for each task
        column = lambda c: np.array([x[c] for x in found]).reshape(-1, replicates)
        return column("ru").sum(axis=0), column("uv").sum(axis=0), column("top").max(axis=0, initial=0)

    def scaled(values: dict[str, np.ndarray]) -> None:
        values["u"] = values["r"] / (values["n"] + prior)

    state = times(totals.select("i", "n", zeros.alias("x"), "r", *[zeros.alias(c) for c in "upqv"]), scaled)
    before, alpha = None, None
    for _ in range(limit):
        ru, uv, top = dots(state)
        if not (top > tolerance).any():
            break
        with np.errstate(divide="ignore", invalid="ignore"):
            beta = np.where((before > 0), ru / before, 0.0) if before is not None else np.zeros(replicates)
            down = uv - (np.where(alpha != 0, beta * ru / alpha, 0.0) if alpha is not None else 0.0)
            alpha = np.where((down > 0) & (top > tolerance), ru / down, 0.0)
        before = ru

        def step(values: dict[str, np.ndarray], alpha: np.ndarray = alpha, beta: np.ndarray = beta) -> None:
            values["p"] = values["u"] + beta * values["p"]
            values["q"] = values["v"] + beta * values["q"]
            values["x"] = values["x"] + alpha * values["p"]
            values["r"] = values["r"] - alpha * values["q"]
            values["u"] = values["r"] / (values["n"] + prior)

        last, state = state, times(state, step)
        dropped(last)  # two states are there at most
    else:
        raise ValueError(f"ratings have not converged to {tolerance} in {limit} steps")

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, n = matrix(batch, "x", replicates), matrix(batch, "n", replicates)
                ratings = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * replicates), pa.array(x.reshape(-1), mask=~(n > 0).reshape(-1)))
                yield pa.RecordBatch.from_arrays([batch.column("i"), ratings, listed(n)], names=["i", "ratings", "weight"])

    return state.select("i", "x", "n").mapInArrow(read, StructType([totals.schema["i"], *StructType.fromDDL("ratings array<double>, weight array<double>")]))


def solved(edges: DataFrame, a: str, b: str, weights: str, sums: str, replicates: int, prior: float = 8.0, tolerance: float = 1e-10, limit: int = 500) -> DataFrame:
    """Shrunk ratings of all replicates: a, ratings (array, null where the node has no edge in a replicate), weight (array).

    ``weights`` and ``sums`` are arrays: in replicate r, rating_i = sum(sums[r] + weights[r] * rating_j) / (sum(weights[r]) + prior).
    Edges must lie both ways with equal weights; edges of one pair are added up. The systems are solved by conjugate
    gradients scaled by the diagonal until no replicate's scaled residual is ``tolerance``; what does not get there in
    ``limit`` steps is an error. A row of sums, three numbers a replicate, reaches the driver a step.
    """
    pairs = kept(vector_sums(edges.select(F.col(a).alias("i"), F.col(b).alias("j"), F.col(weights).alias("w"), F.col(sums).alias("s")), ["i", "j"], ["w", "s"], replicates), "pairs")
    totals = vector_sums(pairs.select("i", F.col("w").alias("n"), F.col("s").alias("r")), ["i"], ["n", "r"], replicates)

    def pulled(state: DataFrame) -> DataFrame:
        met = pairs.select("i", "j", "w").join(state.select(F.col("i").alias("j"), "u"), "j").select("i", "w", "u")

        def weighed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    order = np.argsort(batch.column("i").to_numpy(zero_copy_only=False), kind="stable")
                    yield pa.RecordBatch.from_arrays([batch.column("i").take(pa.array(order)), listed((matrix(batch, "w", replicates) * matrix(batch, "u", replicates))[order])], names=["i", "s"])

        return vector_sums(met.mapInArrow(weighed, StructType([pairs.schema["i"], *StructType.fromDDL("s array<double>")])), ["i"], ["s"], replicates)

    out = _conjugate(totals, pulled, replicates, prior, tolerance, limit).withColumnRenamed("i", a)
    dropped(pairs)
    return out


#: A list of edges of one end holds so many at most; a task's sums and a vector that is broadcast so many bytes.
LISTED, HELD = 256, 1 << 26


def _lists(edges: DataFrame) -> DataFrame:
    """j and the lists of its edges (i, c, w, and all that follows w), by ranges of j and i: near ends lie together, and one with many edges is in several rows and tasks."""
    rows = edges.repartitionByRange("j", "i").sortWithinPartitions("j", "i").select("j", *[c for c in edges.columns if c != "j"])
    names = rows.columns[1:]
    schema = StructType([rows.schema["j"], *StructType.fromDDL(", ".join(f"{c} array<{rows.schema[c].dataType.simpleString()}>" for c in names))])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                starts = np.union1d(_runs(batch, ["j"]), np.arange(0, batch.num_rows, LISTED))
                ends = pa.array(np.append(starts, batch.num_rows).astype(np.int32))
                yield pa.RecordBatch.from_arrays([batch.column("j").take(pa.array(starts)), *[pa.ListArray.from_arrays(ends, batch.column(n)) for n in names]], names=schema.names)

    return rows.mapInArrow(run, schema)


class _Sums:
    """Sums of rows by id, at most ``HELD`` bytes of them."""

    def __init__(self, width: int) -> None:
        self.most, self.width = max(HELD // (8 * width), 1024), width
        self.ids, self.slots, self.used, self.rows = None, np.empty(0, np.int64), 0, np.empty((0, width))

    def add(self, ids: np.ndarray, rows: np.ndarray) -> None:
        order = np.argsort(ids, kind="stable")
        ids = ids[order]
        starts = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))
        ids, rows = ids[starts], np.add.reduceat(rows[order], starts, axis=0)
        if self.ids is None:
            self.ids = ids[:0]
        at = np.searchsorted(self.ids, ids)
        known = np.zeros(len(ids), bool)
        inside = at < len(self.ids)
        known[inside] = self.ids[at[inside]] == ids[inside]
        self.rows[self.slots[at[known]]] += rows[known]
        if not known.all():
            n = int((~known).sum())
            if self.used + n > len(self.rows):
                self.rows = np.concatenate([self.rows[: self.used], np.empty((max(self.used, n), self.width))])
            self.rows[self.used : self.used + n] = rows[~known]
            self.ids, self.slots = np.insert(self.ids, at[~known], ids[~known]), np.insert(self.slots, at[~known], np.arange(self.used, self.used + n))
            self.used += n

    def taken(self, names: list[str], kind: pa.DataType, form: Callable[[np.ndarray], pa.Array] = listed) -> Iterator[pa.RecordBatch]:
        """The sums by ascending id, in columns made by ``form``, which are then forgotten."""
        for lo in range(0, self.used, 4096):
            rows = self.rows[self.slots[lo : lo + 4096]]
            yield pa.RecordBatch.from_arrays([pa.array(self.ids[lo : lo + 4096], kind), *[form(x) for x in np.split(rows, len(names) - 1, axis=1)]], names=names)
        self.__init__(self.width)


def _sent(size: int, shares: np.ndarray, names: list[str], kind: pa.DataType) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """What the edges of lists send to their ends i: w * share * u, or w * share and g * share if the rows have no u."""
    met, each = names == ["i", "s"], shares.shape[1]  # size is so often ``each`` as there are totals
    block = max((1 << 21) // (size * (len(names) - 1)), 256)
    alike = (shares == 1).all()  # then an edge counts once in every problem

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = _Sums(size * (len(names) - 1))
        for batch in batches:
            if not batch.num_rows:
                continue
            ends, c, w = (batch.column(n).flatten().to_numpy(zero_copy_only=False) for n in "icw")
            row = np.repeat(np.arange(batch.num_rows), np.diff(batch.column("i").offsets.to_numpy()))
            u = matrix(batch, "u", size) if met else None
            gs = [] if met else [batch.column(f"g{k}").flatten().to_numpy(zero_copy_only=False) for k in range(size // each)]
            for lo in range(0, len(ends), block):
                at = slice(lo, lo + block)
                one = w[at, None] * u[row[at]] if met else np.repeat(w[at, None], size, axis=1)
                own = None if alike else shares[c[at]]
                if own is not None:  # alike for all totals
                    one = (one.reshape(len(one), -1, each) * own[:, None]).reshape(len(one), -1)
                if not met:
                    one = np.concatenate([one, *[np.repeat(g[at, None], each, axis=1) if alike else g[at, None] * own for g in gs]], axis=1)
                sums.add(ends[at], one)
                if sums.used > sums.most:
                    yield from sums.taken(names, kind, packed)
        yield from sums.taken(names, kind, packed)

    return run


def solved_together(edges: DataFrame, a: str, b: str, weight: str, total: str | list[str], priors: np.ndarray, kind: str | None = None, shares: np.ndarray | None = None, tolerance: float = 1e-10, limit: int = 3000) -> DataFrame:
    """Shrunk ratings of several problems on the same edges: a, ratings (array, null where the node has no edge in a problem), weight (array).

    In problem p an edge counts shares[kind, p] times (once without ``kind``, a number from 0), and rating_i = sum(share * (total +
    weight * rating_j)) / (sum(share * weight) + priors[p]). So an edge is one row with two numbers, however many problems there are:
    the edges of an end b lie in lists, a list meets the end's vector once, and what it sends is added up in the task before it
    travels. Vectors of up to ``HELD`` bytes are broadcast, so that edges stay where they are; larger ones meet the lists by a
    shuffle. Edges must lie both ways with equal weights. ``solved`` tells the rest. With several totals there are all problems for
    each, one total after the other.
    """
    totals_ = [total] if isinstance(total, str) else total
    shares = np.ones((1, len(priors))) if shares is None else np.asarray(shares, float)
    priors = np.tile(np.asarray(priors, float), len(totals_))
    size = len(priors)
    rows = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(F.col(a).alias("i"), F.col(b).alias("j"), (F.col(kind) if kind else F.lit(0)).cast("int").alias("c"), F.col(weight).cast("double").alias("w"), *[F.col(g).cast("double").alias(f"g{k}") for k, g in enumerate(totals_)])
    lists = kept(_lists(rows), "lists")
    end = lists.schema["i"].dataType.elementType
    ids = to_arrow_type(end)
    vectors = lambda names: StructType([StructField("i", end), *StructType.fromDDL(", ".join(f"{n} binary" for n in names))])
    totals = kept(vector_sums(lists.mapInArrow(_sent(size, shares, ["i", "n", "r"], ids), vectors("nr")), ["i"], ["n", "r"], size), "totals")
    small = totals.count() * size * 8 <= HELD

    def pulled(state: DataFrame) -> DataFrame:
        u = state.select(F.col("i").alias("j"), "u")
        met = lists.select("j", "i", "c", "w").join(F.broadcast(u) if small else u, "j")
        return vector_sums(met.mapInArrow(_sent(size, shares, ["i", "s"], ids), vectors("s")), ["i"], ["s"], size)

    out = _conjugate(totals, pulled, size, priors, tolerance, limit).withColumnRenamed("i", a)
    dropped(lists, totals)
    return out


def drawn_names(kind: pa.DataType, groups: int) -> list[tuple[str, pa.DataType]]:
    """Columns of lists of drawn edges: an end, its edges' other ends and what they say of it, and their counts, pressed, in each group of replicates."""
    return [("j", kind), ("i", pa.list_(kind)), ("g", pa.list_(pa.float64())), *[(f"w{k}", pa.binary()) for k in range(groups)]]


def drawn_lists(j: np.ndarray, i: np.ndarray, g: np.ndarray, counts: list[np.ndarray], kind: pa.DataType) -> pa.RecordBatch:
    """Lists of edges that are sorted by ``j``: at most ``LISTED`` of an end in a row, its counts (bytes, a row an edge) one after another under zstd."""
    codec = pa.Codec("zstd", 1)
    starts = np.union1d(np.flatnonzero(np.append(True, j[1:] != j[:-1])[: len(j)]), np.arange(0, len(j), LISTED)).astype(np.int64)
    ends = np.append(starts, len(j)).astype(np.int32)
    names = drawn_names(kind, len(counts))
    lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(x, t.value_type)) for x, (_, t) in zip((i, g), names[1:3])]
    pressed = [pa.array([codec.compress(np.ascontiguousarray(w[lo:hi]), asbytes=True) for lo, hi in zip(ends, ends[1:])], pa.binary()) for w in counts]
    return pa.RecordBatch.from_arrays([pa.array(j[starts], kind), *lists, *pressed], names=[n for n, _ in names])


def _drawn_together(short: DataFrame, widths: list[int], tasks: int) -> DataFrame:
    """Lists of the same ends, put together as far as they meet: by ranges of ends, so that near ones lie together and one with many edges is in several rows and tasks."""
    first = F.col("i")[0].alias("_i")
    rows = short.select("*", first).repartitionByRange(tasks, "j", "_i").sortWithinPartitions("j", "_i").drop("_i")
    names, kind = [f"w{k}" for k in range(len(widths))], to_arrow_type(short.schema["j"].dataType)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd")
        for whole in batches:
            many = np.append(0, np.cumsum(np.diff(whole.column("i").offsets.to_numpy()))) if whole.num_rows else np.zeros(1, int)
            lo = 0
            while lo < whole.num_rows:  # as many rows as hold about 2 ** 15 edges
                hi = max(int(np.searchsorted(many, many[lo] + (1 << 15), side="right")) - 1, lo + 1)
                batch, size = whole.slice(lo, hi - lo), np.diff(many[lo : hi + 1])
                flat = [batch.column(n).flatten().to_numpy(zero_copy_only=False) for n in "ig"]
                counts = [np.concatenate([np.frombuffer(codec.decompress(z.as_buffer(), int(n) * w), np.uint8) for z, n in zip(batch.column(name), size)]).reshape(-1, w) for name, w in zip(names, widths)]
                yield drawn_lists(np.repeat(batch.column("j").to_numpy(zero_copy_only=False), size), *flat, counts, kind)
                lo = hi

    return rows.mapInArrow(run, short.schema)


def _counts_of(batch: pa.RecordBatch, size: int) -> Iterator[tuple[int, int, int, np.ndarray]]:
    """For each list its row, where its edges begin and end among those of the batch, and their counts."""
    codec, z = pa.Codec("zstd"), batch.column("w")
    ends = np.append(0, np.cumsum(np.diff(batch.column("i").offsets.to_numpy()))).tolist()
    for k, (lo, hi) in enumerate(zip(ends, ends[1:])):
        yield k, lo, hi, np.frombuffer(codec.decompress(z[k].as_buffer(), (hi - lo) * size), np.uint8).reshape(-1, size)


def _drawn_totals(size: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """n and r of each list's own end: its counts, and its counts times what the edges say of it."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                g = batch.column("g").flatten().to_numpy()
                n, r = np.empty((batch.num_rows, size)), np.empty((batch.num_rows, size))
                for k, lo, hi, w in _counts_of(batch, size):
                    n[k], r[k] = w.sum(axis=0), g[lo:hi] @ w.astype(float)
                yield pa.RecordBatch.from_arrays([batch.column("j"), packed(n), packed(r)], names=["i", "n", "r"])

    return run


def _drawn_sent(size: int, kind: pa.DataType) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """What the edges of lists send to their ends i: their counts times u. A list's ends differ, so it is added at once."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, one = _Sums(size), np.empty((LISTED, size))
        for batch in batches:
            if not batch.num_rows:
                continue
            u = matrix(batch, "u", size)
            ids, at = np.unique(batch.column("i").flatten().to_numpy(zero_copy_only=False), return_inverse=True)
            rows = np.zeros((len(ids), size))
            for k, lo, hi, w in _counts_of(batch, size):
                rows[at[lo:hi]] += np.multiply(w, u[k], out=one[: hi - lo])
            sums.add(ids, rows)
            if sums.used > sums.most:
                yield from sums.taken(["i", "s"], kind, packed)
        yield from sums.taken(["i", "s"], kind, packed)

    return run


def solved_draws(edges: DataFrame, a: str, widths: list[int], nodes: int, pairs: int, prior: float = 8.0, tolerance: float = 1e-10, limit: int = 500) -> DataFrame:
    """As ``solved``, for ``edges`` both ways, each pair once, in lists (``drawn_lists``), which are used up: g is what an edge says of j, a byte of w how often a replicate has it.

    So a replicate costs an edge a byte, not two numbers, and travels pressed. The edges of an end lie in lists that stay where they are.
    The replicates of one w are solved together, and their vector is broadcast; ``edge_draws.bootstrapped`` gives a w as many as ``HELD`` bytes allow with ``nodes`` ends.
    """
    spark = edges.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * pairs * sum(widths) // HELD)
    lists = kept(_drawn_together(edges, widths, tasks), "lists", compression="none")  # they are pressed already
    dropped(edges)
    end = lists.schema["j"].dataType
    vectors = lambda names: StructType([StructField("i", end), *StructType.fromDDL(", ".join(f"{n} binary" for n in names))])
    out = None
    for k, size in enumerate(widths):
        mine = lists.select("j", "i", "g", F.col(f"w{k}").alias("w"))
        totals = kept(vector_sums(mine.mapInArrow(_drawn_totals(size), vectors("nr")), ["i"], ["n", "r"], size), "totals")

        def pulled(state: DataFrame, mine: DataFrame = mine, size: int = size) -> DataFrame:
            u = state.select(F.col("i").alias("j"), "u")
            met = mine.drop("g").join(F.broadcast(u) if nodes * size * 8 <= HELD else u, "j")
            return vector_sums(met.mapInArrow(_drawn_sent(size, to_arrow_type(end)), vectors("s")), ["i"], ["s"], size)

        found = _conjugate(totals, pulled, size, prior, tolerance, limit).select("i", "ratings", "weight")
        dropped(totals)
        if out is not None:
            found = found.select("i", F.col("ratings").alias("_r"), F.col("weight").alias("_w"))
            found = out.join(found, "i").select("i", F.concat("ratings", "_r").alias("ratings"), F.concat("weight", "_w").alias("weight"))
        out = found
    dropped(lists)
    return out.withColumnRenamed("i", a)


def intervals(df: DataFrame, entity: str, values: str, share: float, low: float = 0.05, high: float = 0.95) -> DataFrame:
    """entity, present (values that are no nulls), low and high: quantiles, linear between values, for entities with at least ``share`` of the values."""
    schema = StructType([df.schema[entity], *StructType.fromDDL("present long, low double, high double")])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                column = batch.column(values)
                rows = matrix(batch, values, len(column[0]))
                present = (~np.isnan(rows)).sum(axis=1)
                enough = (present > 0) & (present >= share * rows.shape[1])
                ends = np.full((2, len(rows)), np.nan)
                if enough.any():
                    ends[:, enough] = np.nanquantile(rows[enough], [low, high], axis=1)
                found = [pa.array(present.astype(np.int64)), *[pa.array(e, mask=~enough) for e in ends]]
                yield pa.RecordBatch.from_arrays([batch.column(entity), *found], names=schema.names)

    return df.select(entity, values).mapInArrow(run, schema)

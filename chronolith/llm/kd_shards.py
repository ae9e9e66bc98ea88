"""Sharding by a k-d tree, with DataFrame functions only.

Each round gives every node that still holds more than one shard a cut along its widest metadata dimension, at the
weighted median (or the third, for a node of three shards) of its bytes. Medians are distributed: bytes are summed by
node and 15-bit digit of a 60-bit key, digit by digit, so that only some thousand sums a node are shuffled and one
number a node reaches the driver. After a level's first digit only the rows inside the cuts' digits are read on.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.window import Window

from chronolith.llm.text import keep

DIGIT = 15
#: Bits of a key: the dimension's own value, then the text's hash, the id's and the row's, which part equal values, texts and rows.
VALUE, TEXT, ID, ROW = 22, 12, 10, 16
_TIE = TEXT + ID + ROW


def _value(field: T.StructField) -> Column:
    """A dimension as a number; null is below all values."""
    c = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.NumericType | T.BooleanType):
        return c.cast("double")
    if isinstance(field.dataType, T.DateType | T.TimestampType):
        return F.unix_micros(c.cast("timestamp")).cast("double")
    return F.pmod(F.xxhash64(c), F.lit(1 << 40)).cast("double")  # unordered values: any fixed order keeps equal ones together


def _keys(docs: DataFrame, dims: list[str], salt: int) -> DataFrame:
    """Adds a 60-bit order key k0, k1, ... for each dimension and drops the dimension."""
    fields = [docs.schema[d] for d in dims]
    raw = docs.withColumns({f"v{i}": F.when(~F.isnan(_value(f)), _value(f)) for i, f in enumerate(fields)})
    ends = raw.agg(*[g(f"v{i}").alias(f"{n}{i}") for i in range(len(dims)) for g, n in ((F.min, "a"), (F.max, "b"))]).first()
    part = lambda bits, *c: F.pmod(F.xxhash64(*c, F.lit(salt)), F.lit(1 << bits))
    tie = part(TEXT, "text_crc32", "size") * (1 << (ID + ROW)) + part(ID, "doc_id") * (1 << ROW) + part(ROW, "row")
    for i in range(len(dims)):
        a, b = ends[f"a{i}"], ends[f"b{i}"]
        step = F.lit(0.0) if a is None or a == b else (F.col(f"v{i}") - F.lit(a)) / F.lit(b - a)
        raw = raw.withColumn(f"k{i}", F.coalesce(F.floor(step * ((1 << VALUE) - 2)).cast("long") + 1, F.lit(0).cast("long")) * (1 << _TIE) + tie)
    return raw.drop(*[f"v{i}" for i in range(len(dims))])


def _cuts(rows: DataFrame, nodes: dict[int, tuple[int, float]]) -> dict[int, int]:
    """node -> least key of its right part. nodes: (dimension, share of the bytes that goes left). Rows: node, key, size."""
    shares = F.create_map(*[F.lit(x) for n, (_, s) in nodes.items() for x in (n, float(s))])
    prefix: dict[int, int] = {n: 0 for n in nodes}
    want: dict[int, float | None] = {n: None for n in nodes}  # bytes that are still to go left inside the prefix
    for low in range(60 - DIGIT, -1, -DIGIT):
        known = F.create_map(*[F.lit(x) for n in nodes for x in (n, prefix[n])])
        inside = rows if low == 60 - DIGIT else rows.where(F.shiftright("key", low + DIGIT) == known[F.col("node")])
        if low == 60 - 2 * DIGIT:
            inside = rows = keep(inside, "inside")
        sums = inside.groupBy("node", F.shiftright("key", low).alias("digit")).agg(F.sum("size").alias("size"))
        by = Window.partitionBy("node")  # at most 1 << DIGIT rows a node
        run = sums.withColumns({"upto": F.sum("size").over(by.orderBy("digit")), "all": F.sum("size").over(by)})
        first = want[next(iter(nodes))] is None
        goal = F.col("all") * shares[F.col("node")] if first else F.create_map(*[F.lit(x) for n in nodes for x in (n, float(want[n] or 0))])[F.col("node")]
        got = run.withColumn("goal", goal).groupBy("node").agg(
            F.min(F.when(F.col("upto") >= F.col("goal"), F.struct("digit", F.col("upto") - F.col("size"), "goal", "size"))).alias("at"), F.max("digit").alias("last"), F.max("all").alias("all")
        )
        for r in got.collect():
            digit, before, goal_, size = r["at"] or (r["last"] + 1, r["all"], r["all"], 0)
            prefix[r["node"]], want[r["node"]] = digit, goal_ - before
            if low == 0 and goal_ - before > size / 2:  # the last row goes to the side that it leaves nearer to the goal
                prefix[r["node"]] = digit + 1
    return prefix


def kd_shards(docs: DataFrame, shards: int = 24, dims: tuple[str, ...] = ("n_chars", "lang", "source"), salt: int = 7) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for each row of ``docs``; law is ``bytes``.

    Size: UTF-8 bytes of the text plus 8. Leaves are the shards; a node of s shards is cut at floor(s/2)/s of its bytes,
    so leaves hold near equal bytes whatever the metadata; missing dimensions are left out, and without any the rows' hash
    serves. Equal values, and then equal texts, lie next to each other in every key, so a cut parts them only where it
    must. Null text: no bytes and checksum 0; null values come first. Null ids and repeated rows are parted like others, by
    a number that each row gets when the metadata is written. An empty table gives no rows. slot is gapless from 0 in each
    shard; grown_shard is null.
    """
    if shards < 1:
        raise ValueError("shards must be positive")
    dims_ = [d for d in dims if d in docs.columns and d not in ("doc_id", "text", "size", "text_crc32", "row")]
    text = F.col("text").cast("string")
    base = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long").alias("size"),
        F.coalesce(F.crc32(F.encode(text, "utf-8")), F.lit(0)).cast("long").alias("text_crc32"),
        F.monotonically_increasing_id().alias("row"),
        *[F.col(d) for d in dims_],
    )
    if not dims_:
        base, dims_ = base.withColumn("dim_0", F.xxhash64("doc_id", F.lit(salt))), ["dim_0"]
    rows, nd = keep(_keys(keep(base, "meta"), dims_, salt), "keys"), len(dims_)
    leaves, tree = {0: (0, shards)}, {}  # node -> (first shard, shards); node -> (dimension, cut)

    def place(node: int, first: int, many: int, leaf: Callable[[int, int], int]) -> Column:
        """The tree as one expression: its size is that of the tree, whatever the depth."""
        if node not in tree:
            return F.lit(leaf(node, first))
        d, cut = tree[node]
        return F.when(F.col(f"k{d}") < cut, place(2 * node + 1, first, many // 2, leaf)).otherwise(place(2 * node + 2, first + many // 2, many - many // 2, leaf))

    while open_ := {n: x for n, x in leaves.items() if x[1] > 1}:
        live = rows.withColumn("node", place(0, 0, shards, lambda node, first: node)).where(F.col("node").isin(*open_))
        wide = live.groupBy("node").agg(*[F.shiftright(F.max(f"k{i}"), _TIE).alias(f"b{i}") for i in range(nd)], *[F.shiftright(F.min(f"k{i}"), _TIE).alias(f"a{i}") for i in range(nd)])
        # every dimension's key runs from its least to its largest value in the whole table: widths are comparable
        widest = {r["node"]: max(range(nd), key=lambda i: (r[f"b{i}"] - r[f"a{i}"], -i)) for r in wide.collect()}
        plan = {n: (widest[n], (open_[n][1] // 2) / open_[n][1]) for n in open_ if n in widest}
        if not plan:
            break
        key = reduce(lambda c, n: c.when(F.col("node") == n, F.col(f"k{plan[n][0]}")), plan, F.when(F.lit(False), F.lit(0).cast("long")))
        at = _cuts(live.select("node", key.alias("key"), "size"), plan)
        tree |= {n: (plan[n][0], at[n]) for n in plan}
        leaves = {c: x for n, (first, many) in open_.items() if n in plan for c, x in ((2 * n + 1, (first, many // 2)), (2 * n + 2, (first + many // 2, many - many // 2)))}
    placed = rows.select("doc_id", "size", "text_crc32", "row", place(0, 0, shards, lambda node, first: first).cast("int").alias("shard"))
    return _slotted(keep(placed, "placed")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def _slotted(placed: DataFrame, rows_a_part: int = 200_000) -> DataFrame:
    """Adds slot: rows of a shard are numbered in parts of bounded size, whose offsets come from the parts' counts."""
    many = placed.count()
    parts = max(1, min(1 << 20, -(-many // rows_a_part)))
    part = F.pmod(F.xxhash64("doc_id", "row"), F.lit(parts)).cast("int")
    dealt = placed.withColumn("part", part)
    counts = dealt.groupBy("shard", "part").agg(F.count("*").alias("n"))
    offsets = counts.select("shard", "part", (F.sum("n").over(Window.partitionBy("shard").orderBy("part")) - F.col("n")).alias("before"))
    within = F.row_number().over(Window.partitionBy("shard", "part").orderBy("doc_id", "text_crc32", "size", "row")) - 1
    return dealt.withColumn("within", within).join(offsets, ["shard", "part"]).withColumn("slot", (F.col("before") + F.col("within")).cast("long"))

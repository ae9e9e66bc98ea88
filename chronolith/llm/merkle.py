"""A Merkle manifest of a table: groups' trees under a tree of groups, proofs for all rows and their verification.

A level turns every ``fanout`` consecutive nodes of a group into their parent by one aggregation: conditional aggregates
spread a parent's children over ``fanout`` columns (the slot pivot). The columns' concatenation, hashed, is the parent; the
columns without a child's own are its siblings. Proofs then come down from the root, a level a join, so that only
1/fanout of the rows meet the levels above. Levels are written: each is 1/fanout of the one below it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from chronolith.llm.order import numbered
from chronolith.llm.text import keep

FANOUT = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the parts, concatenated; null parts are left out."""
    return F.sha2(F.concat_ws("", *parts), 256)


def field(value: Column) -> Column:
    """A field's part of a leaf: its bytes of UTF-8, a colon and the value; ``-`` for null. No two rows of fields give one string."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def lower_cased(docs: DataFrame) -> dict[str, Column]:
    """The stated tampering: rows whose decimal doc_id has a CRC-32 that 3 divides get A-Z of their text lower-cased. Null ids and texts stay."""
    hit = F.crc32(F.encode(F.col("doc_id").cast("string"), "utf-8")) % 3 == 0
    text = F.col("text").cast("string")
    return {"text": F.when(hit, F.translate(text, _UPPER, _LOWER)).otherwise(text)}


def leaves(docs: DataFrame, fields: tuple[str, ...] = FIELDS, tamper: dict[str, Column] | None = None) -> DataFrame:
    """doc_id, lang, leaf and tampered (the leaf with the columns of ``tamper`` in place of the fields) of each row. Columns that are missing count as null."""
    own = {f: F.col(f) if f in docs.columns else F.lit(None).cast("string") for f in fields}
    changed = own | (tamper or {})
    return docs.select(own["doc_id"].alias("doc_id"), own["lang"].cast("string").alias("lang"), digest(*map(field, own.values())).alias("leaf"), digest(*map(field, changed.values())).alias("tampered"))


def _climb(nodes: DataFrame, payload: tuple[str, ...], depth: int, fanout: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """The runs of each level, and the nodes of each level that are their group's last.

    nodes: node_group, place (gapless from 0 in the group), remain (the level's nodes of the group), h and the payload, which
    level 0 keeps beside each child.
    """
    runs, tops = [], []
    for level in range(depth + 1):
        tops.append(nodes.where("remain = 1"))
        if level == depth:
            break
        child = F.struct("h", *(payload if level == 0 else ()))
        slots = [F.max(F.when(F.col("place") % fanout == k, child)).alias(f"c{k}") for k in range(fanout)]
        up = nodes.where("remain > 1").groupBy("node_group", F.floor(F.col("place") / fanout).alias("place")).agg(F.max("remain").alias("remain"), *slots)
        up = up.withColumns({"h": digest(*[F.col(f"c{k}.h") for k in range(fanout)]), "remain": F.ceil(F.col("remain") / fanout)})
        runs.append(keep(up, f"level_{level}"))
        nodes = runs[-1].select("node_group", "place", "remain", "h")
    return runs, tops


def _descend(runs: list[DataFrame], tops: list[DataFrame], start: DataFrame, payload: tuple[str, ...], fanout: int) -> DataFrame:
    """payload, h and path of each node of level 0: path holds (before, after), what stands beside the node at each level, up to the root.

    start: node_group, path of the group's top, and what all its nodes get. A level's nodes join their parents by group and place.
    """
    given = [c for c in start.columns if c not in ("node_group", "path")]
    known = None
    for level in range(len(tops) - 1, -1, -1):
        mine = tops[level].join(start, "node_group").select("node_group", "place", *(("h", *payload) if level == 0 else ()), "path", *given)
        if level < len(runs):
            parents = known.select("node_group", "place", "path", *given)
            met = runs[level].drop("h", "remain").join(parents, ["node_group", "place"])
            hashes = [F.col(f"c{k}.h") for k in range(fanout)]
            # concat_ws leaves out the slots that a short run hasn't
            beside = lambda k: F.struct(F.concat_ws("", *hashes[:k]).alias("before"), F.concat_ws("", *hashes[k + 1 :]).alias("after"))
            each = F.filter(F.array(*[F.struct((F.col("place") * fanout + k).alias("place"), F.col(f"c{k}").alias("own"), beside(k).alias("beside")) for k in range(fanout)]), lambda x: x["own"].isNotNull())
            child = met.select("node_group", F.explode(each).alias("x"), F.col("path").alias("above"), *given)
            path = F.concat(F.array("x.beside"), F.col("above"))
            more = [F.col("x.own.h").alias("h"), *[F.col(f"x.own.{p}").alias(p) for p in payload]] if level == 0 else []
            mine = mine.unionByName(child.select("node_group", "x.place", *more, path.alias("path"), *given))
        known = mine
    return known


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path give."""
    return F.aggregate(path, leaf, lambda h, x: F.sha2(F.concat(x["before"], h, x["after"]), 256))


def depth_of(n: int | None, fanout: int = FANOUT) -> int:
    levels, n = 0, n or 0
    while n > 1:
        levels, n = levels + 1, -(-n // fanout)
    return levels


def manifest(docs: DataFrame, fields: tuple[str, ...] = FIELDS, tamper: Callable[[DataFrame], dict[str, Column]] | None = lower_cased, fanout: int = FANOUT) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of each row of ``docs``.

    A row's leaf is the digest of its fields, a null of which is ``-``; an empty text is no null, and long texts are hashed
    whole. Leaves ascend in their lang by doc_id (null first), then by their digest; rows that are equal in all take
    neighbouring places. Langs ascend bytewise, null first, and a null lang is a lang. Rows without an id are leaves like
    others and are never tampered with. Columns besides the fields, whatever their names, take no part. An empty table has no rows, and no root.
    """
    order = [F.col("lang").asc_nulls_first(), F.col("doc_id").asc_nulls_first(), F.col("leaf"), F.col("_row")]
    made = leaves(docs, fields, tamper(docs) if tamper else None)
    rows = numbered(keep(made.withColumn("_row", F.monotonically_increasing_id()), "leaves"), order, "leaves_in_order")
    langs = keep(rows.groupBy("lang").agg(F.min("pos").alias("node_group"), F.count("*").alias("remain")), "langs")
    size = langs.agg(F.max("remain"), F.count("*")).first()  # one row
    placed = rows.join(langs, rows["lang"].eqNullSafe(langs["lang"])).select("node_group", (F.col("pos") - F.col("node_group")).alias("place"), "remain", F.col("leaf").alias("h"), "doc_id", "tampered")
    leaf_payload = ("doc_id", "tampered")
    runs, tops = _climb(placed, leaf_payload, depth_of(size[0], fanout), fanout)
    subroots = None
    for t in tops:
        subroots = t.select("node_group", "h") if subroots is None else subroots.unionByName(t.select("node_group", "h"))
    # groups are numbered by their first leaf's place, which ascends as the langs do
    heads = numbered(subroots, [F.col("node_group")], "subroots").select(F.lit(0).cast("long").alias("node_group"), F.col("pos").alias("place"), F.lit(size[1]).cast("long").alias("remain"), "h", F.col("node_group").alias("lang_group"))
    up, last = _climb(heads, ("lang_group",), depth_of(size[1], fanout), fanout)
    empty = F.array().cast("array<struct<before:string,after:string>>")
    start = last[-1].select("node_group", empty.alias("path"), F.col("h").alias("root"))
    groups = _descend(up, last, start, ("lang_group",), fanout).select(F.col("lang_group").alias("node_group"), "path", F.col("h").alias("subroot"), "root")
    whole = _descend(runs, tops, keep(groups, "group_paths"), leaf_payload, fanout)
    siblings = F.concat_ws("", F.transform("path", lambda x: F.concat(x["before"], x["after"])))
    out = whole.select("doc_id", F.col("h").alias("leaf"), "subroot", "root", F.sha2(siblings, 256).alias("proof_sha256"), folded(F.col("tampered"), F.col("path")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))

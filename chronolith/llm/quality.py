"""Quality rules as a bitmask ledger.

Every rule is evaluated once: the ledger stores one failure bit a rule and the measurements behind it. A policy is a
versioned set of rules that reject; it is applied to the ledger, and ablations count documents by bitwise aggregation.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from chronolith.llm.text import map_rows, windows, word_hashes

WINDOW = 8
_SPACE, _SYMBOLS = " \t\n\v\f\r", "#*$%&|<>"
Measure = Callable[[str], Column]
MEASURES = "n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long"

#: (name, condition on the measurements under which a document fails); a rule's bit is its place. Rules are only appended.
RULES: tuple[tuple[str, Callable[[Measure], Column]], ...] = (
    ("too_few_words", lambda m: m("n_words") < 20),
    ("repeated_windows", lambda m: 100 * m("n_repeat_words") > 30 * m("n_words")),
    ("symbols", lambda m: m("n_symbols") > m("n_words")),
    ("duplicate_lines", lambda m: (m("n_lines") >= 4) & (2 * m("n_dup_lines") > m("n_lines"))),
    ("long_words", lambda m: m("word_chars") > 40 * m("n_words")),
    ("short_words", lambda m: m("word_chars") < 2 * m("n_words")),
)


@dataclass(frozen=True)
class Policy:
    """Rules that reject, under a version that results carry."""

    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        names = [n for n, _ in RULES]
        if unknown := set(self.rules) - set(names):
            raise ValueError(f"no such rules: {sorted(unknown)}")
        return sum(1 << names.index(r) for r in self.rules)


BASE = Policy("base-1", ("too_few_words", "repeated_windows"))
STANDARD = Policy("standard-1", tuple(n for n, _ in RULES))


def measures(text: str | None) -> tuple[int, int, int, int, int, int]:
    """Measurements of one text, as listed in ``MEASURES``; None has zeros."""
    text = text or ""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    lines = [x for x in data.split(b"\n") if x.strip()]
    repeated = 0
    if len(words) > WINDOW:
        _, where, count = np.unique(windows(word_hashes(words), WINDOW), return_inverse=True, return_counts=True)
        if len(count) < len(where):
            starts = np.flatnonzero(count[where] > 1)
            edge = np.bincount(starts, minlength=len(words) + 1) - np.bincount(starts + WINDOW, minlength=len(words) + 1)
            repeated = int((np.cumsum(edge) > 0).sum())
    return len(words), len(text) - sum(map(text.count, _SPACE)), sum(map(text.count, _SYMBOLS)), len(lines), len(lines) - len(set(lines)), repeated


def measured(docs: DataFrame, prefix: str = "", drop: tuple[str, ...] = ()) -> DataFrame:
    """``docs`` (but for ``drop``) with the measurements of each text and fail_bits (bit i: rule i of ``RULES`` failed), under ``prefix``."""
    kinds = [c.split() for c in MEASURES.split(", ")]

    def change(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = zip(*map(measures, batch.column("text").to_pylist()), strict=True)
        return pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(x, pa.int64()) for x in found)], names=[*batch.schema.names, *(prefix + n for n, _ in kinds)])

    rows = map_rows(docs, change, ", ".join(f"`{prefix}{n}` {kind}" for n, kind in kinds), drop)
    bits = F.lit(0).cast("long")
    for i, (_, failed) in enumerate(RULES):
        bits = bits + F.when(failed(lambda n: F.col(f"`{prefix}{n}`")), F.lit(1 << i)).otherwise(0)
    return rows.withColumn(prefix + "fail_bits", bits)


def ledger(docs: DataFrame) -> DataFrame:
    """doc_id, the measurements and fail_bits (bit i: rule i of ``RULES`` failed) for each row of ``docs``.

    Null or empty text: all measurements are 0, so only ``too_few_words`` fails. Ids may be null or repeated; columns
    other than doc_id and text are not read; an empty table gives no rows. Store it: policies and ablations read the
    ledger, not the texts.
    """
    return measured(docs.select("doc_id", "text"), drop=("text",))


def passes(policy: Policy, bits: str = "fail_bits") -> Column:
    return F.col(f"`{bits}`").bitwiseAND(F.lit(policy.mask)) == 0


def verdicts(book: DataFrame, policy: Policy = STANDARD) -> DataFrame:
    """The ledger with base_failed, kept and the policy's version."""
    return book.withColumns({"base_failed": ~passes(BASE), "kept": passes(policy) & passes(BASE), "policy": F.lit(policy.version)})


def ablations(book: DataFrame, policy: Policy = STANDARD) -> DataFrame:
    """For each rule of a policy: failed, failed_alone (what dropping the rule would keep) and kept_by_policy; one pass over the distinct masks."""
    masks = book.groupBy("fail_bits").agg(F.count("*").alias("n"))
    rules = [F.struct(F.lit(n).alias("rule"), F.lit(1 << i).cast("long").alias("bit")) for i, (n, _) in enumerate(RULES) if n in policy.rules]
    hit = F.col("fail_bits").bitwiseAND(F.lit(policy.mask))
    each = masks.select("n", hit.alias("hit"), F.explode(F.array(*rules)).alias("r")).select("n", "hit", "r.*")
    return each.groupBy("rule").agg(
        F.sum(F.when(F.col("hit").bitwiseAND(F.col("bit")) != 0, F.col("n")).otherwise(0)).alias("failed"),
        F.sum(F.when(F.col("hit") == F.col("bit"), F.col("n")).otherwise(0)).alias("failed_alone"),
        F.sum(F.when(F.col("hit") == 0, F.col("n")).otherwise(0)).alias("kept_by_policy"),
    )


def filtered(docs: DataFrame, policy: Policy = STANDARD) -> DataFrame:
    """Rows of ``docs`` that a policy keeps, with all their columns; a null text fails as an empty one does."""
    own = "quality" + "_" * (1 + max(map(len, docs.columns)))
    bits = own + "fail_bits"
    return measured(docs, own).where(passes(policy, bits) & passes(BASE, bits)).select(*[F.col(f"`{c}`") for c in docs.columns])

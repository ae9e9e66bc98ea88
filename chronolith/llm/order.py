"""Places of rows in a total order, without sorting the table or a hot group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from chronolith.llm.text import keep

#: Bits of a row's number inside its partition in Spark's monotonically increasing ids.
_INSIDE = 33


def numbered(df: DataFrame, order: list[Column], tag: str = "numbered") -> DataFrame:
    """``df`` with ``pos``: its place, gapless from 0, in the order given, which should be total if places are to be the same each time.

    Rows are parted by range, sorted and numbered inside their part and written, so that lost executors change no place; a
    part's offset comes from the parts' counts, which are one row for each part. An empty table gives no rows.
    """
    sorted_ = keep(df.orderBy(*order).withColumn("_m", F.monotonically_increasing_id()), tag)
    part, inside = F.shiftright("_m", _INSIDE), F.col("_m").bitwiseAND(F.lit((1 << _INSIDE) - 1))
    counts = sorted_.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    offsets = counts.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))  # a row for each partition
    return sorted_.withColumn("_part", part).join(F.broadcast(offsets), "_part").withColumn("pos", F.col("_before") + inside).drop("_part", "_before", "_m")

"""Token counts: batches balanced by bytes are encoded in Arrow functions that return lengths only; long texts are split at safe boundaries."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame

from chronolith.llm.text import map_rows
from chronolith.llm.vocab import encoder


def token_counts(docs: DataFrame, vocabulary: str, limit: int = 512) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for each row of ``docs``.

    Null or empty text: 0 bytes and tokens. Ids may be null or repeated; other columns are not read; an empty table gives no rows.
    """

    def change(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column("text").to_pylist()
        n = encoder(vocabulary).counts(texts)
        size = [len((t or "").encode()) for t in texts]
        more = [pa.array(size, pa.int64()), pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())]
        return pa.RecordBatch.from_arrays([*batch.columns, *more], names=[*batch.schema.names, "n_bytes", "n_tokens", "over_limit"])

    return map_rows(docs.select("doc_id", "text"), change, "n_bytes long, n_tokens long, over_limit boolean", ("text",))

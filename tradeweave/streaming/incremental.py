"""Mapping of trade rows as they arrive.

Dictionary matching and the gate work row by row against static dictionaries, so the operators run
on each micro-batch as they do on a table; a batch that is tried again replaces what it wrote.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def map_stream(rows: DataFrame, transform: Callable[[DataFrame], DataFrame], path: str, checkpoint: str) -> StreamingQuery:
    """Writes ``transform`` of each micro-batch of ``rows`` below ``path``, one folder per batch."""

    def each(batch: DataFrame, number: int) -> None:
        transform(batch).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return rows.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

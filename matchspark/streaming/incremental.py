"""New catalog rows as they come: each micro-batch goes through the same DataFrame operators and is appended."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def match_stream(rows: DataFrame, match: Callable[[DataFrame], DataFrame], out: str, checkpoint: str) -> StreamingQuery:
    """Append match(batch) to the table at out, one folder a batch, so a batch that runs again replaces its own rows."""

    def each(batch: DataFrame, number: int) -> None:
        match(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return rows.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

"""Linking of records as they arrive: retrieval against a standing clean source, a micro-batch at a time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..functions.normalize import normalized
from ..operators import retrieve


def link_stream(raw: DataFrame, clean: DataFrame, target: str, checkpoint: str, params: retrieve.Reverse = retrieve.Reverse()) -> StreamingQuery:
    """Appends each batch's candidates to the Parquet table at target; raw streams records with source, clean is normalised.

    A batch that is run again overwrites its own partition, so restarts don't repeat rows."""

    def handle(batch: DataFrame, number: int) -> None:
        found = retrieve.reverse(clean, normalized(batch), params)
        found.write.mode("overwrite").parquet(f"{target}/batch={number}")

    return raw.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

"""Structured Streaming into a collection: each micro-batch is one commit."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources.store import Collection


def write_stream(stream: DataFrame, collection: Collection, checkpoint: str, *, order_by: str | None = None, trigger: dict | None = None) -> StreamingQuery:
    """Upsert a stream with ``_id``; of repeated ids in a batch the one with the largest ``order_by`` counts.

    A batch that is retried after a failure writes the same rows again, which leaves the newest row of each id as it was.
    """

    def batch(df: DataFrame, _: int) -> None:
        if order_by:
            newest = Window.partitionBy("_id").orderBy(F.desc(order_by))
            df = df.withColumn("__n", F.row_number().over(newest)).filter("__n = 1").drop("__n")
        if not df.isEmpty():
            collection.upsert_frame(df)

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()

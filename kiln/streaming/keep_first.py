"""Keep-first across landed batches, as a streaming aggregate.

The state of a key is its first row by event order (``min`` of order and row) and the number of
rows seen; it lives in the query's checkpoint, so a batch that lands tomorrow knows the keys
of all earlier ones. Rows are combined before the shuffle, so a key that holds a third of a
batch is one row a task. In update mode every micro-batch gives the keys it touched with their
first row so far, written under ``batch=<id>`` with overwrite (a replayed batch replaces its
own output). A late copy that comes first by event order takes the place of the row kept until
then: a key's first row only ever gets smaller, so the table at any time is the least of what
was written for each key.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def keep_first_stream(stream: DataFrame, key: list[str], order: list[str], out: str,
                      checkpoint: str | None = None) -> int:
    """Run ``stream`` to its end (``availableNow``); returns the number of micro-batches.

    Null keys count as equal to each other; of rows alike in key and order the least by all
    columns is kept."""
    columns = [c for c in stream.columns if c not in key]
    firsts = stream.groupBy(*key).agg(
        F.min(F.struct(*order, *[c for c in columns if c not in order])).alias("first"),
        F.count("*").alias("copies"))
    batches = []

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(os.path.join(out, f"batch={batch_id}"))
        batches.append(batch_id)

    q = (firsts.writeStream.outputMode("update").foreachBatch(write_batch)
         .option("checkpointLocation", checkpoint or os.path.join(out, "_checkpoint"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return len(batches)


def read_first(spark: SparkSession, out: str, key: list[str]) -> DataFrame:
    """The kept row of every key over all batches so far, with ``copies``, the rows it had."""
    written = spark.read.parquet(out)
    least = written.groupBy(*key).agg(F.min("first").alias("first"), F.max("copies").alias("copies"))
    return least.select(*key, "first.*", "copies")

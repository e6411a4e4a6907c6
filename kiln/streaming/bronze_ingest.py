"""Incremental bronze ingest with Structured Streaming.

The raw layer is "append what landed": a file source over ``<landing>/<table>/`` with
``trigger(availableNow=True)`` picks up only files it has not seen (the source log in
the checkpoint remembers them), so re-running never duplicates rows. The stream carries the
files' paths alone; each micro-batch reads its files with the batch reader (own headers, quotes,
null tokens, audited lines) and is written to its own ``batch=<id>`` folder with overwrite, so a
batch replayed after a failure replaces its own output. The checkpoint lies beside the landed
tables, so a later session goes on where the last one stopped.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kiln.schemas import TableSpec
from kiln.sources.csv import line_audit, loaded, read_lines

#: Files of a micro-batch: their paths are what the driver holds of it.
FILES_PER_BATCH = 10_000


def ingest_landing(spark: SparkSession, landing_dir: str, bronze_root: str, spec: TableSpec,
                   checkpoint: str | None = None, null_tokens: list[str] | None = None,
                   multi_line: bool = False, files_per_batch: int = FILES_PER_BATCH) -> int:
    """Land every new CSV file of ``spec`` and stop; returns the number of micro-batches.

    Lines with too many cells are not landed; these and short lines are listed under
    ``_lines/<table>``."""
    ckpt = checkpoint or os.path.join(bronze_root, "_checkpoints", spec.name)
    # only paths are selected, so no file's content is read by the stream
    src = (spark.readStream.format("binaryFile").option("maxFilesPerTrigger", files_per_batch)
           .schema("path string, modificationTime timestamp, length long, content binary")
           .load(os.path.join(landing_dir, spec.name)).select("path"))
    out = os.path.join(bronze_root, spec.name)
    audit = os.path.join(bronze_root, "_lines", spec.name)
    batches = []

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        paths = sorted(r.path for r in batch.collect())  # at most files_per_batch names
        if not paths:
            return
        lines = read_lines(batch.sparkSession, paths, spec.bronze_schema(), null_tokens,
                           multi_line=multi_line)
        lines = lines.withColumn("_seq", F.struct(F.lit(batch_id).cast("bigint").alias("batch"),
                                                  "_seq.file", "_seq.block", "_seq.pos"))
        loaded(lines).write.mode("overwrite").parquet(os.path.join(out, f"batch={batch_id}"))
        line_audit(lines).write.mode("overwrite").parquet(os.path.join(audit, f"batch={batch_id}"))
        batches.append(batch_id)

    q = (src.writeStream.foreachBatch(write_batch).option("checkpointLocation", ckpt)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return len(batches)


def read_bronze(spark: SparkSession, bronze_root: str, spec: TableSpec) -> DataFrame:
    """All landed batches of a table; ``_seq`` orders rows by batch, then file order."""
    return spark.read.parquet(os.path.join(bronze_root, spec.name))


def read_line_audit(spark: SparkSession, bronze_root: str, spec: TableSpec) -> DataFrame:
    """Lines with too many or too few cells of all landed batches."""
    return spark.read.parquet(os.path.join(bronze_root, "_lines", spec.name))

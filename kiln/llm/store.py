"""Intermediate tables in the folder that ``spark.checkpoint.dir`` names.

Operators that read a result several times, or that loop, write it once as Parquet in
the shared checkpoint folder and read it back: lineage is cut, a lost executor only
costs the tasks that ran there, and later steps read just the columns they need.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``; a scratch folder on a local master only."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        base = tempfile.mkdtemp(prefix="kiln-llm-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


#: Folders of all operator calls of this process, in order.
folders: list[str] = []


def delete(spark: SparkSession, folder: str) -> None:
    sc = spark.sparkContext
    at = sc._jvm.org.apache.hadoop.fs.Path(folder)
    at.getFileSystem(sc._jsc.hadoopConfiguration()).delete(at, True)


class Stage:
    """Staged tables of one operator call; ``drop`` frees those no longer needed."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/kiln-llm/{name}-{uuid.uuid4().hex[:12]}"
        folders.append(self.root)
        self._n = 0
        # Texts can be very long: fewer rows travel to Python workers at once.
        if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > 1000:
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 1000)

    def path(self, name: str) -> str:
        self._n += 1
        return f"{self.root}/{self._n:03d}-{name}"

    def put(self, df: DataFrame, name: str) -> DataFrame:
        where = self.path(name)
        # Spark deletes the shuffle files of finished steps when the driver collects their
        # plans; asking for it here keeps only the current step's files on the disks.
        self.spark.sparkContext._jvm.System.gc()
        df.write.parquet(where)
        back = self.spark.read.schema(df.schema).parquet(where)
        back._kiln_path = where
        return back

    def drop(self, *tables: DataFrame | None) -> None:
        for t in tables:
            where = getattr(t, "_kiln_path", None)
            if where:
                delete(self.spark, where)

"""Writing layers and exports."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from kiln.sources.csv import CSV_DIALECT


def layer_path(root: str, layer: str, table: str) -> str:
    return f"{root.rstrip('/')}/{layer}/{table}"


def write_observed(df: DataFrame, path: str, metrics: dict[str, Column] | None = None,
                   mode: str = "overwrite") -> dict:
    """Write parquet; the row count (``rows``) and ``metrics``, aggregates without distinct, as
    the write itself saw them: one mergeable row of state a task, no second scan."""
    obs = Observation(f"write_{uuid.uuid4().hex}")
    seen = df.observe(obs, F.count(F.lit(1)).alias("rows"),
                      *[c.alias(n) for n, c in (metrics or {}).items()])
    seen.write.mode(mode).parquet(path)
    return {"rows": 0, **obs.get}


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int | None = None,
                   metrics: dict[str, Column] | None = None) -> tuple[DataFrame, dict]:
    """Write parquet in buckets of ``key``, sorted by it, and give the table as a bucketed scan
    and what the write observed. Tables bucketed alike are joined and grouped by the key
    without an exchange. Buckets are a property of a catalog table; its entry is taken out
    again as soon as the scan is resolved, so no run leaves one. The number of buckets is
    ``spark.sql.shuffle.partitions`` unless given."""
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    obs, name = Observation(f"write_{uuid.uuid4().hex}"), f"kiln_bucketed_{uuid.uuid4().hex}"
    seen = df.repartition(n, key).observe(obs, F.count(F.lit(1)).alias("rows"),
                                          *[c.alias(m) for m, c in (metrics or {}).items()])
    try:
        (seen.write.bucketBy(n, key).sortBy(key).option("path", path).mode("errorifexists")
         .format("parquet").saveAsTable(name))
        table = spark.table(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")   # an external table: its files stay
    return table, {"rows": 0, **obs.get}


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> int:
    """Write parquet and return the row count seen by the write."""
    return int(write_observed(df, path, mode=mode)["rows"])


def _fs(spark: SparkSession, path: str):
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


class LayerRun:
    """A full refresh of one layer that is seen whole or not at all.

    Tables are written to a fresh folder of the run; ``publish`` then makes the layer's pointer
    name that folder, by one atomic rename. A run that fails or dies before leaves the previous
    layer as it was. ``tables`` says what the pointer names; the previous run's folder stays for
    readers that still hold it, older ones are deleted.
    """

    POINTER = "_current"

    def __init__(self, spark: SparkSession, root: str, layer: str, run_id: str):
        self.spark, self.layer = spark, layer
        self.base = layer_path(root, layer, "").rstrip("/")
        self.run = f"run-{run_id}-{uuid.uuid4().hex[:8]}"
        self._scans: dict[str, DataFrame] = {}

    def path(self, table: str) -> str:
        return f"{self.base}/{self.run}/{table}"

    def write(self, df: DataFrame, table: str, metrics: dict[str, Column] | None = None,
              bucket: str | None = None) -> dict:
        """Write a table, in buckets of a column if one is named; what the write observed."""
        if bucket is None:
            return write_observed(df, self.path(table), metrics, mode="errorifexists")
        self._scans[table], seen = write_bucketed(df, self.path(table), bucket, metrics=metrics)
        return seen

    def read(self, table: str) -> DataFrame:
        """The run's own table, published or not; a bucketed scan if it was written so."""
        if table in self._scans:
            return self._scans[table]
        return self.spark.read.parquet(self.path(table))

    def publish(self) -> None:
        jvm = self.spark.sparkContext._jvm
        fs, pointer = _fs(self.spark, f"{self.base}/{self.POINTER}")
        previous = current_run(self.spark, self.base)
        fs.mkdirs(pointer.getParent())
        fresh = jvm.org.apache.hadoop.fs.Path(f"{self.base}/_next-{self.run}")
        out = fs.create(fresh, True)
        try:
            out.write(bytearray(self.run.encode()))
        finally:
            out.close()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            fs.getUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        rename = jvm.org.apache.hadoop.fs.Options.Rename
        options = self.spark.sparkContext._gateway.new_array(rename, 1)
        options[0] = rename.OVERWRITE
        context.rename(fresh, pointer, options)
        for status in fs.listStatus(pointer.getParent()):
            name = status.getPath().getName()
            if name.startswith("run-") and name not in (self.run, previous):
                fs.delete(status.getPath(), True)


def current_run(spark: SparkSession, base: str) -> str | None:
    """The run that a layer's pointer names; None before the first one is published."""
    fs, pointer = _fs(spark, f"{base}/{LayerRun.POINTER}")
    if not fs.exists(pointer):
        return None
    stream = fs.open(pointer)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def table_path(spark: SparkSession, root: str, layer: str, table: str) -> str:
    """Where the published table lies."""
    base = layer_path(root, layer, "").rstrip("/")
    run = current_run(spark, base)
    if run is None:
        raise FileNotFoundError(f"{base}: nothing published")
    return f"{base}/{run}/{table}"


def read_layer(spark: SparkSession, root: str, layer: str, table: str) -> DataFrame:
    """Table scan of the published layer."""
    return spark.read.parquet(table_path(spark, root, layer, table))


def layer_tables(spark: SparkSession, root: str, layer: str) -> list[str]:
    """Names of the published tables of a layer; none before the first run."""
    base = layer_path(root, layer, "").rstrip("/")
    run = current_run(spark, base)
    if run is None:
        return []
    fs, folder = _fs(spark, f"{base}/{run}")
    return sorted(s.getPath().getName() for s in fs.listStatus(folder)
                  if s.isDirectory() and not s.getPath().getName().startswith(("_", ".")))


def export_csv(df: DataFrame, path: str, single_file: bool = False,
               order_by: list[str] | None = None) -> None:
    """Replace a CSV snapshot (header row). ``single_file`` funnels through one task, so
    use it only for small outputs such as the reconciliation report; ``order_by`` names columns
    that order the rows of a file and are not written."""
    out = df.coalesce(1) if single_file else df
    if order_by:
        out = out.sortWithinPartitions(*order_by).drop(*order_by)
    (out.write.mode("overwrite").options(**CSV_DIALECT)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def publish_snapshot(df: DataFrame, export_root: str, name: str) -> str:
    """Clear the named target and write the table as a fresh CSV snapshot."""
    path = f"{export_root.rstrip('/')}/{name}"
    export_csv(df, path)
    return path

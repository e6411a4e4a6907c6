"""End-to-end run: bronze -> silver/audit -> constraints -> gold -> reconciliation ->
published snapshots.

Every layer but bronze is a full refresh in a folder of its own (``sinks.LayerRun``): silver and
audit become visible together once the constraints are settled, gold and reports together
once the report is written, so a run that fails leaves the layers as they were. Each table is
written once and the next layer reads the written table, so a lost executor only ever
recomputes work since the last layer, and no plan grows across layers. What the report says
of silver is observed by the writes. Failures propagate (no step is skipped silently).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from kiln.operators import expectations as X
from kiln.operators.aggregates import mode_by
from kiln.operators.conform import conform
from kiln.plans import entities as E
from kiln.plans import gold as G
from kiln.plans import reconcile as R
from kiln.schemas import TABLES
from kiln.session import ensure_checkpoint_dir
from kiln.sources import testdata as TD
from kiln.sources.csv import line_audit, loaded, read_lines
from kiln.sources.sinks import (
    LayerRun, export_csv, layer_path, layer_tables, publish_snapshot, read_layer, table_path, write_table,
)


@dataclass
class PipelineConfig:
    root: str                              # warehouse root (shared storage)
    raw_dir: str | None = None             # CSV landing: <raw_dir>/<table>.csv, a file or a folder of files
    sf_dir: str | None = None              # or: benchmark parquet tables mapped to the entities
    batch_id: str = field(default_factory=lambda: datetime.now().strftime("%Y%m%d%H%M%S"))
    as_of: str | None = None               # date for the 30-day window (default: today)
    constraints: str = "fail"              # "fail" | "quarantine" | "report"
    export_dir: str | None = None          # publish gold snapshots here (CSV)
    dashboard: bool = True
    null_tokens: list[str] | None = None
    multi_line: tuple[str, ...] = ("feedback",)  # tables whose cells may hold line breaks


def _bronze(spark: SparkSession, cfg: PipelineConfig) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """Land raw tables as all-text parquet, one folder per batch (a re-run of the same batch
    replaces it instead of duplicating rows), with the lines that are audited (CSV only)."""
    rows, audits = {}, {}
    for name, spec in TABLES.items():
        path = f"{layer_path(cfg.root, 'bronze', name)}/batch_id={cfg.batch_id}"
        if cfg.sf_dir:
            write_table(TD.BRONZE_BUILDERS[name](spark, cfg.sf_dir), path)
            rows[name] = spark.read.parquet(path)
            continue
        # a missing file stops the run: an empty table would pass for a complete result
        lines = read_lines(spark, f"{cfg.raw_dir}/{name}.csv", spec.bronze_schema(), cfg.null_tokens,
                           multi_line=name in cfg.multi_line)
        write_table(lines, path)
        landed = spark.read.schema(lines.schema).parquet(path)
        rows[name], audits[name] = loaded(landed), line_audit(landed)
    return rows, audits


def _settle(silver: dict[str, DataFrame], cfg: PipelineConfig) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """Silver rows that stay and, in quarantine mode, those that the constraints take out."""
    if cfg.constraints == "quarantine":
        found = X.quarantine(silver, {n: t.checks for n, t in TABLES.items()}, E.parquet_stage)
        return found.kept, found.rejected
    if cfg.constraints not in ("fail", "report"):
        raise ValueError(f"constraints: {cfg.constraints}")
    return silver, {}


def _violations(silver: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName,
                  [X.violations(df, n, TABLES[n].checks, silver) for n, df in silver.items()])


BY_RIDE = ("rides", "payments", "feedback")
GOLD_INPUTS = ("users", "rides", "payments", "feedback")


def gold_and_report(spark: SparkSession, silver: dict[str, DataFrame], seen: dict[str, dict],
                    write: Callable[[str, str, DataFrame], DataFrame],
                    as_of: str | None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Write both gold aggregates and reconcile them with what the writes of silver have seen
    (``seen``: observed metrics by table). The report reads gold alone; the two averages that
    need groups are observed inside the gold writes."""
    users, rides, payments, feedback = (silver[n] for n in GOLD_INPUTS)
    active, rated = Observation(f"active_{uuid.uuid4().hex}"), Observation(f"rated_{uuid.uuid4().hex}")
    mean = F.try_divide(F.col("ur_all_sum"), F.nullif("ur_all_n", F.lit(0)).cast("double"))
    ua = write("gold", "user_aggregate", G.user_aggregate(
        users, rides, payments, feedback, as_of,
        observe=lambda df: df.observe(active, F.count_if(F.col("active") > 0).alias("n"))))
    ca = write("gold", "captain_aggregate", G.captain_aggregate(
        silver["captains"], rides, payments, feedback,
        observe=lambda df: df.observe(rated, F.avg(mean).alias("mean"))))
    issue = R.most_common(seen["feedback"].get("issues"), lambda: mode_by(
        feedback, [], "issue_category").first()[0])
    return ua, ca, R.report(
        R.compare(R.observed_user_metrics(spark, seen, active.get.get("n", 0), issue),
                  R.user_metrics_gold(ua), "User"),
        R.compare(R.observed_captain_metrics(spark, seen, rated.get.get("mean")),
                  R.captain_metrics_gold(ca), "Captain"))


def run(spark: SparkSession, cfg: PipelineConfig) -> dict:
    """Run every layer; returns row counts per written table and the report path."""
    ensure_checkpoint_dir(spark)
    ts = datetime.now()
    runs = {n: LayerRun(spark, cfg.root, n, cfg.batch_id) for n in ("silver", "audit", "gold", "reports")}
    counts: dict[str, int] = {}
    seen: dict[str, dict] = {}

    def write(layer: str, table: str, df: DataFrame, metrics=None, bucket=None) -> DataFrame:
        seen[f"{layer}.{table}"] = observed = runs[layer].write(df, table, metrics, bucket)
        counts[f"{layer}.{table}"] = int(observed["rows"])
        return runs[layer].read(table)

    bronze, lines = _bronze(spark, cfg)
    cleaned = E.build_silver(bronze, ts)
    typed, taken = _settle({n: conform(r.clean, TABLES[n]) for n, r in cleaned.items()}, cfg)
    # the gold layer joins and groups these by their ride: co-bucketed, they need no exchange
    silver = {n: write("silver", n, df, R.write_metrics(n, cfg.as_of),
                       "ride_id" if n in BY_RIDE else None) for n, df in typed.items()}
    for name, result in cleaned.items():
        rejects = result.rejects
        if name in taken:
            stamp = F.lit(ts).cast("timestamp").alias("run_ts")
            rejects = rejects.unionByName(taken[name].select("*", stamp).drop("depth"))
        write("audit", name, rejects)
        write("audit", f"{name}_cells", result.cells)
        if name in lines:
            write("audit", f"{name}_lines", lines[name])
    left = write("reports", "constraint_violations", _violations(silver)).where("violations > 0").collect()
    if left and cfg.constraints == "fail":
        raise X.ExpectationError("; ".join(f"{r.table_name}.{r.column_name} {r.check_name}={r.violations}"
                                           for r in left))
    runs["silver"].publish()
    runs["audit"].publish()

    ua, ca, rep = gold_and_report(spark, silver, {n: seen[f"silver.{n}"] for n in TABLES}, write, cfg.as_of)
    if cfg.dashboard:
        write("gold", "dashboard_data", G.dashboard(*(silver[n] for n in GOLD_INPUTS), silver["captains"]))
    rep = write("reports", "reconciliation", rep)
    export_csv(R.report_text(rep), runs["reports"].path("reconciliation_csv"), single_file=True,
               order_by=["_position"])
    runs["gold"].publish()
    runs["reports"].publish()

    if cfg.export_dir:
        publish_snapshot(ua, cfg.export_dir, "users_data")
        publish_snapshot(ca, cfg.export_dir, "captains_data")
    return {"counts": counts, "report": table_path(spark, cfg.root, "reports", "reconciliation"),
            "batch_id": cfg.batch_id}


def register_layers(spark: SparkSession, root: str, layers=("silver", "audit", "gold", "reports")) -> list[str]:
    """Expose the published tables to Spark SQL as temp views named ``<layer>_<table>``
    (e.g. ``SELECT * FROM gold_captain_aggregate``). Returns the view names."""
    names = []
    for layer in layers:
        for table in layer_tables(spark, root, layer):
            if table.endswith("_csv"):
                continue
            read_layer(spark, root, layer, table).createOrReplaceTempView(f"{layer}_{table}")
            names.append(f"{layer}_{table}")
    return names

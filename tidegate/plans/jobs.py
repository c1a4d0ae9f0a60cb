"""Jobs described by configuration: sources to views, SQL or hierarchy steps, one target."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from tidegate.operators.feeds import log_status
from tidegate.operators.hierarchy import hierarchy, shape_hierarchy

AUDIT_SCHEMA = "job string, batch_date string, status string, message string, started_at timestamp, logged_at timestamp"


def _require(config: Mapping, *path: str):
    value = config
    for part in path:
        if value is None or part not in value:
            raise ValueError(f"missing {'.'.join(path)} in configuration")
        value = value[part]
    return value


def extract(spark: SparkSession, job: Mapping) -> None:
    """Register each source under its view name."""
    for source in job.get("sources", []):
        reader = spark.read.format(source.get("format", "parquet")).options(**source.get("options", {}))
        reader.load(source["object"]).createOrReplaceTempView(source["view"])


def expand_graph(spark: SparkSession, graph: Mapping) -> DataFrame:
    """Hierarchy step: vertices and edges views in, output view out."""
    result = hierarchy(
        spark.table(_require(graph, "vertices")),
        spark.table(_require(graph, "edges")),
        _require(graph, "startswith", "column"),
        _require(graph, "startswith", "value"),
        _require(graph, "startswith", "max_iter"),
        _require(graph, "startswith", "checkpoint_interval"),
    )
    shaped = shape_hierarchy(result, *_require(graph, "output", "columns"))
    shaped.createOrReplaceTempView(_require(graph, "output", "view"))
    return shaped


def transform(spark: SparkSession, job: Mapping) -> None:
    """Run the steps in order; a SQL step with `view` names its result, else it is a statement."""
    for step in job.get("transforms", []):
        if "graph" in step:
            expand_graph(spark, step["graph"])
        elif "view" in step:
            spark.sql(step["sql"]).createOrReplaceTempView(step["view"])
        else:
            spark.sql(step["sql"])


def load(spark: SparkSession, job: Mapping, batch_date: str) -> str | None:
    """Write the target view below its location, as the snapshot of `batch_date`."""
    target = job.get("targets")
    if not target:
        return None
    path = f"{target['target_location'].rstrip('/')}/batch_date={batch_date}"
    spark.table(target["view"]).write.mode("overwrite").format(target.get("format", "parquet")).save(path)
    return path


def run_jobs(spark: SparkSession, config: Mapping, batch_date: str, audit_path: str | None = None) -> list[str]:
    """Run all jobs; each leaves an audit row, and a failure is logged before it is raised."""
    written = []
    for job in config.get("jobs") or []:
        started = datetime.now(timezone.utc)
        status, message = "SUCCEEDED", None
        try:
            extract(spark, job)
            transform(spark, job)
            path = load(spark, job, batch_date)
            if path:
                written.append(path)
        except Exception as problem:
            status, message = "FAILED", str(problem)
            raise
        finally:
            if audit_path:
                row = (job.get("name"), batch_date, status, message, started, datetime.now(timezone.utc))
                log_status(spark, audit_path, spark.createDataFrame([row], AUDIT_SCHEMA))
    return written

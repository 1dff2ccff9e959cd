"""All-or-nothing publish: the gate is read first, then every table is written to a fresh run
folder, and only then the pointer names the run. Readers follow the pointer, so a failed or lost
job leaves the last complete run in place."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class PublishRefused(RuntimeError):
    """At least one field failed; nothing was written."""


def publish(tables: dict[str, DataFrame], root: str, failures: DataFrame,
            allow_incomplete: bool = False) -> str:
    """Write ``tables`` under ``root`` and return the run folder. ``failures`` has kind, name,
    status, message."""
    shown = failures.orderBy("kind", "name").limit(50).collect()
    if shown and not allow_incomplete:
        lines = [f"{r['status'].upper()} {r['kind']} {r['name']}: {r['message']}" for r in shown]
        raise PublishRefused(f"nothing was written, {failures.count()} failures:\n  " + "\n  ".join(lines))
    run = f"{root.rstrip('/')}/runs/{uuid.uuid4().hex}"
    for name, df in tables.items():
        df.write.mode("errorifexists").parquet(f"{run}/{name}")
    spark = failures.sparkSession
    spark.range(1).select(F.lit(run).alias("run"), F.lit(0 if shown else 1).alias("complete"),
                          F.current_timestamp().alias("published_at")).coalesce(1).write.mode(
        "append").parquet(f"{root.rstrip('/')}/pointer")
    return run


def latest_run(spark: SparkSession, root: str, allow_incomplete: bool = False) -> str:
    """Folder of the latest run; an incomplete one is refused unless it is asked for."""
    last = spark.read.parquet(f"{root.rstrip('/')}/pointer").agg(F.max_by(F.struct("run", "complete"), "published_at").alias("r")).first()["r"]
    if not last["complete"] and not allow_incomplete:
        raise PublishRefused(f"the latest run is incomplete: {last['run']}")
    return last["run"]


def read_published(spark: SparkSession, root: str, table: str, allow_incomplete: bool = False) -> DataFrame:
    return spark.read.parquet(f"{latest_run(spark, root, allow_incomplete)}/{table}")

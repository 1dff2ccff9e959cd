"""Cutting lineage in the shared checkpoint folder, so lost executors cost only their own work; starting independent steps together."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def checkpoint_folder(spark: SparkSession) -> str:
    """The folder the cluster names; a scratch one only for local sessions that name none."""
    context = spark.sparkContext
    named = spark.conf.get(SETTING, None)
    current = context.getCheckpointDir()
    if current:
        return current
    if named is None:
        if not context.master.startswith("local"):
            raise RuntimeError(f"{SETTING} must name a folder every executor can reach")
        named = tempfile.mkdtemp(prefix="checkpoint-")
    context.setCheckpointDir(named)
    return named


def cut(df: DataFrame) -> DataFrame:
    """Write the rows once as a table in the checkpoint folder and continue from it.

    Unlike a row checkpoint, the table keeps column pruning and a measured size, so later joins
    broadcast only what the files show to be small.
    """
    spark = df.sparkSession
    path = f"{checkpoint_folder(spark).rstrip('/')}/cut-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def together(*steps: Callable) -> list:
    """Results of steps that do not need each other, in their order; their Spark jobs share the cores.

    A fit is a chain of small jobs that leave most cores idle, so chains that run side by side take the time of the longest. The
    first failure is raised once all of them have ended.
    """
    inherit = inheritable_thread_target(SparkSession.active())
    with ThreadPoolExecutor(max(1, len(steps))) as pool:
        ends = [pool.submit(inherit(step)) for step in steps]
    return [end.result() for end in ends]

"""Session settings and the shared folder for written intermediate tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

# Ticket times carry no zone, so date arithmetic must never meet a daylight-saving gap. Stages whose
# generated method is too big for the JVM's JIT compiler run faster without whole-stage code.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def prepare(spark: SparkSession) -> None:
    """Give the caller's session the SETTINGS that all results rest on; they stay set."""
    for name, value in SETTINGS.items():
        if spark.conf.get(name) != value:
            spark.conf.set(name, value)


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the cluster's shared checkpoint directory, which executors must see.

    That is the setting ``spark.checkpoint.dir`` or, without it, the context's checkpoint directory.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def spread_small(df: DataFrame, scan: DataFrame | None = None) -> DataFrame:
    """Deal the rows of a scan with few splits over all cores, ahead of per-row work.

    A scan of a large table has more splits than the cluster has cores and stays as it is. ``scan``
    is the plain scan below ``df``, whose splits are known without running anything.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    splits = (df if scan is None else scan).rdd.getNumPartitions()
    return df.repartition(cores) if 2 * splits <= cores else df


def side_by_side(spark: SparkSession, jobs: Sequence[Callable[[], object]]) -> list:
    """Run independent Spark jobs at the same time; small ones then fill gaps of large ones."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        return [f.result() for f in
                [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]]

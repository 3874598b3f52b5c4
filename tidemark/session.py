"""Session defaults and the shared work folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# Settings every operator relies on. Partition counts and memory stay with the cluster.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(app_name: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC time, adaptive execution and dynamic partition overwrite."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**BASE_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names, else one below the warehouse, which is shared where tables are."""
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_work"
        context.setCheckpointDir(root)
    elif not context.getCheckpointDir():
        context.setCheckpointDir(root)
    return root


def workdir(spark: SparkSession, purpose: str) -> str:
    """A fresh path under the checkpoint root for tables and stream state of one run."""
    return f"{checkpoint_root(spark).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"

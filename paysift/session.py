"""Session defaults and the shared checkpoint folder."""

from __future__ import annotations

import os
import sys
import tempfile
import uuid

from pyspark import cloudpickle
from pyspark.sql import SparkSession

SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "paysift", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the defaults above; `conf` keys use `__` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return prepare(builder.getOrCreate())


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the runtime settings results depend on, on a session made elsewhere.

    Functions sent to Python workers are pickled by value, so executors need not have this package.
    """
    cloudpickle.register_pickle_by_value(sys.modules[__package__])
    for key, value in SESSION_DEFAULTS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder for checkpoints and intermediate tables.

    The cluster names it in `spark.checkpoint.dir`.  Only a local session without
    that setting gets a folder of its own; elsewhere the setting is required, since
    a machine-local folder is lost with its machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder shared by all executors")
        named = tempfile.mkdtemp(prefix="paysift-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(named)
    return named


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder; never reused, so no run reads another's files."""
    return os.path.join(shared_dir(spark), "paysift", f"{label}-{uuid.uuid4().hex}")

"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app_name: str = "turnstile", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the settings the library is tested under.

    Broadcast joins are left to the planner: it broadcasts a side only when its
    measured size is under ``spark.sql.autoBroadcastJoinThreshold``, at planning
    time or, under AQE, from the shuffle it has just written.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "static",
    }
    for key, value in {**defaults, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A fresh folder for intermediate tables, on storage every executor can read.

    The cluster names that storage in ``spark.checkpoint.dir``. Only a local
    session may do without the setting and gets a temporary folder; elsewhere the
    executors would each write to a disk of their own, so that is an error.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to storage that the driver and all executors share")
    root = shared.rstrip("/") if shared else tempfile.mkdtemp(prefix="turnstile-")
    return f"{root}/{purpose}-{uuid.uuid4().hex}"


def written_copy(df, purpose: str):
    """``df`` saved once as Parquet and read back, to be scanned several times."""
    path = scratch_path(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

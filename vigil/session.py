"""Session helpers.

Library code never changes session configuration; only entry points
(tests, bench, tools) build a session.  ``checkpoint_dir`` reads the shared
folder the cluster names in ``spark.checkpoint.dir``.
"""
from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str = "local[8]", app: str = "vigil",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    """A local session for tests, bench and tools, with a checkpoint folder of its own."""
    folder = os.environ.get("VIGIL_CHECKPOINT_DIR") or tempfile.mkdtemp(prefix="vigil-ckpt-")
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
         .config("spark.checkpoint.dir", folder)
         .config("spark.driver.memory", "16g"))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir`` (or that the
    caller set on the context), set as the context's checkpoint folder.  Only a
    local session (driver and tasks in one process, as in tests) gets a folder
    of its own where none is set; on a cluster that raises instead."""
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir is not set: name a folder that driver and executors share")
        d = tempfile.mkdtemp(prefix="vigil-ckpt-")
    spark.sparkContext.setCheckpointDir(d)
    return d


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written once as a reliable checkpoint in the shared folder (a job runs)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()

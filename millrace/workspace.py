"""Where the jobs put written tables, stream checkpoints and logs."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the session.

    Only a ``local`` session may fall back to a folder of this machine: there, driver and executors
    are the same process. On a cluster a missing setting is an error.
    """
    root = spark.conf.get(CHECKPOINT_SETTING, None) or spark.sparkContext.getConf().get(CHECKPOINT_SETTING)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_SETTING} to a folder shared by all executors")
    root = tempfile.mkdtemp(prefix="millrace-")
    spark.conf.set(CHECKPOINT_SETTING, root)
    return root


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nobody has used yet. It is not created here."""
    app = spark.sparkContext.applicationId
    return f"{shared_root(spark)}/millrace/{app}/{label}-{uuid.uuid4().hex[:12]}"

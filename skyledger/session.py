"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # A join whose build side turns out this small per partition needs no sorting.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "skyledger", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators count on; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A temporary folder is used only where nothing is named and the session is
    local: executors on other machines could not read it.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        root = tempfile.mkdtemp(prefix="skyledger-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(root)
    return root


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder name under the shared folder; nothing is created yet."""
    return f"{checkpoint_root(spark).rstrip('/')}/skyledger-{label}-{uuid.uuid4().hex}"


def pin(df: DataFrame) -> DataFrame:
    """Store ``df`` through a reliable checkpoint so later reads see the same rows."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def looks_small(df: DataFrame) -> bool:
    """Whether Catalyst's size estimate stays under the session's own broadcast limit."""
    if not hasattr(df, "_jdf"):
        return False
    execution = df._jdf.queryExecution()
    limit = execution.sparkSession().sessionState().conf().autoBroadcastJoinThreshold()
    return int(str(execution.optimizedPlan().stats().sizeInBytes())) <= limit

"""Session settings and the shared folder that checkpoints and written tables go to."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def session(app: str = "kinspan", **conf: str) -> SparkSession:
    """A session with the settings the operators expect; `conf` adds to or overrides them."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        # Hash instead of sort for a shuffled join whose smaller side turned out to fit each task.
        "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
        # Keys are mostly many distinct strings, for which the small first-level map only costs.
        "spark.sql.codegen.aggregate.map.twolevel.enabled": "false",
        # Checkpoint files go once nothing refers to them.
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can read: `spark.checkpoint.dir`, or a temp folder in local mode."""
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if configured:
        if current is None:
            sc.setCheckpointDir(configured)
        return configured
    if current:
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="kinspan-"))
    return sc.getCheckpointDir()


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that nothing has used before."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid4().hex}"


def reliable(df: DataFrame) -> DataFrame:
    """Cut the lineage by a checkpoint in the shared folder, which outlives lost executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def reliable_and_tidy(df: DataFrame) -> DataFrame:
    """As `reliable`, and the shuffle files of the run go when it ends, not with the driver's garbage.

    A frame takes over the setting when it is made, so the run is that of a new one, and no other
    loses its files.
    """
    conf = df.sparkSession.conf
    before = conf.get(TIDY, None)
    conf.set(TIDY, "true")
    try:
        return reliable(df.select("*"))
    finally:
        conf.unset(TIDY) if before is None else conf.set(TIDY, before)

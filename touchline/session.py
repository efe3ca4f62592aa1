"""Session helpers: recommended configuration and the shared scratch folder.

Materialised intermediates (raw shard copies, derived tables written by the
query catalog) go under the folder the cluster names in ``spark.checkpoint.dir``.
A folder of our own is created only when that setting is unset in local mode
(tests); on a cluster an unset folder is an error."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    # compiled plans that a session keeps: a load has more stages than the default of 100, and a
    # plan that is compiled anew starts out interpreted (static: counts for a new session only)
    "spark.sql.codegen.cache.maxEntries": "1000",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # remove checkpoint files of materialised intermediates once unreferenced,
    # and compress them (Spark writes reliable checkpoints uncompressed by default)
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.checkpoint.compress": "true",
}


def build_session(master: str = "local[*]", app: str = "touchline", shuffle_partitions: int = 8,
                  extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(RECOMMENDED_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder for materialised data (``spark.checkpoint.dir``).

    Read from the session; only when it is unset (local runs, tests) a fresh
    folder of our own is created and registered as the checkpoint dir."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir().rstrip("/")
    if not sc.master.split("[")[0] == "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="touchline-"))
    return sc.getCheckpointDir().rstrip("/")


def app_id(spark: SparkSession) -> str:
    return spark.conf.get("spark.app.id", None) or spark.sparkContext.applicationId


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-folder of the shared folder."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")


def materialize(df):
    """Compute ``df`` once and cut its lineage: a reliable checkpoint into the
    shared folder (survives executor loss, unlike a local checkpoint). Used
    where one intermediate feeds several branches of a plan."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)

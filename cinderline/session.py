"""Session settings and the shared checkpoint folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A single-node session for tests and benches; a cluster brings its own."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("cinderline")
    settings = SETTINGS | {
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "12g",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    for key, value in (settings | conf).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def _shared_folder(spark: SparkSession) -> str:
    """The folder all executors share (spark.checkpoint.dir), set for checkpoints where it is not yet.

    Only a local session without that setting gets a temporary folder of its own, which goes when Python ends.
    """
    sc = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None and sc.getCheckpointDir() is not None:
        return sc.getCheckpointDir()
    if shared is None:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="cinderline-checkpoint-")
        atexit.register(shutil.rmtree, shared, ignore_errors=True)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared)
    return shared


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder for files in the shared one."""
    return f"{_shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """checkpoint() into the folder all executors share. Its files go with the table where spark.cleaner.referenceTracking.cleanCheckpoints
    is on, as in local sessions of this package."""
    _shared_folder(df.sparkSession)
    return df.checkpoint(eager=eager)

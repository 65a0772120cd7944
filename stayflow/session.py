"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Counts per token have as many states as there are tokens: they belong on disk, not on the executors' heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}

_local_scratch: str | None = None


def session(app: str = "stayflow", master: str | None = None, conf: dict[str, str] | None = None) -> SparkSession:
    """A session with UTC days and adaptive execution; ``master`` is left to spark-submit by default."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def settle(spark: SparkSession) -> SparkSession:
    """Apply the settings to a session that somebody else has built."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``; a temporary one only on a local master."""
    global _local_scratch
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if _local_scratch is None:
        _local_scratch = tempfile.mkdtemp(prefix="stayflow-")
        atexit.register(shutil.rmtree, _local_scratch, ignore_errors=True)
    return _local_scratch


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A path under the shared folder that no earlier run has used."""
    return f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"

"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

#: Settings the operators assume.  UTC keeps epoch arithmetic and string forms
#: stable; AQE sizes shuffle partitions and splits skewed ones at run time.
ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Join by hash instead of sorting both sides where every build partition is this small.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
}

#: Bytes of a batch of rows on its way to Python.  Spark's own limits, 10,000 rows or 64 MB, hold tens of MB of
#: texts several times over in each task of an executor.
BATCH_BYTES_KEY, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20


def build_session(app_name: str = "tidewell", master: str | None = None,
                  conf: dict[str, str] | None = None) -> SparkSession:
    """Session with the engine settings; ``conf`` wins over them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**ENGINE_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def bounded_batches(spark: SparkSession) -> None:
    """From now on batches of rows sent to Python are small in bytes; a limit the session has stays."""
    if spark.conf.get(BATCH_BYTES_KEY, None) is None:
        spark.conf.set(BATCH_BYTES_KEY, str(BATCH_BYTES))


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a ``local`` master may go without the setting: there the driver's own
    temporary folder is visible to all tasks.  On a cluster a missing setting is
    an error rather than a silent write to one machine's disk.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder shared by the cluster")
    root = tempfile.mkdtemp(prefix="tidewell-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, not yet existing path under the shared folder."""
    return f"{shared_root(spark)}/tidewell/{label}-{uuid.uuid4().hex}"

"""Spark session and shared-storage helpers.

Everything in the library takes a ``SparkSession`` (or a DataFrame) from the caller; this module only
offers a sane default session for tests, benchmarks and scripts, and one place that decides where
intermediate state (checkpoints, table versions written by tests) lives.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def get_session(
    master: str | None = None,
    app_name: str = "sparkmart",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
    driver_memory: str | None = None,
) -> SparkSession:
    """Return (or create) a session with the settings every operator assumes.

    * session time zone pinned to UTC (reference columns are ``timestamptz``);
    * AQE on, with partition coalescing and skew-join splitting;
    * no web UI.

    On a cluster, pass ``master=None`` and let ``spark-submit`` decide; ``shuffle_partitions`` should
    then be sized to the data (roughly input bytes / 128 MB), AQE coalesces the rest at runtime.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        # per-key top-k (paging, capped reads) keeps its map-side partial limit up to this k;
        # Spark's default (1000) would drop it for larger caps and sort hot keys in one task
        "spark.sql.optimizer.windowGroupLimitThreshold": "1000000",
        # staged sources and lineage cuts are removed once their DataFrame is gone
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        # plans of chained loads are deep; keep their logged text bounded
        "spark.sql.maxPlanStringLength": str(256 * 1024),
    }
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if driver_memory:
        conf["spark.driver.memory"] = driver_memory  # only honoured when the JVM starts here
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    # getOrCreate ignores builder options for runtime SQL confs of an existing session: re-apply.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    if shuffle_partitions is not None:
        spark.conf.set("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return spark


def _is_local(spark: SparkSession) -> bool:
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and lineage-cutting tables.

    Read from ``spark.checkpoint.dir`` (or an already configured ``SparkContext`` checkpoint dir).
    Only in local mode (tests) is a private folder created when nothing is configured; on a cluster a
    machine-local folder would be lost with the executor, so an unset value is an error there.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not _is_local(spark):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="sparkmart-ckpt-", dir=os.environ.get("SPARKMART_SCRATCH", "/tmp"))
    spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make ``DataFrame.checkpoint()`` usable and return the folder it writes to."""
    root = checkpoint_root(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


@contextmanager
def plain_variants(spark: SparkSession) -> Iterator[None]:
    """Variant columns are written as they are.  Spark's default infers a schema for each file and takes every
    value apart into typed columns, which a reader of whole payloads has to put together again."""
    name = "spark.sql.variant.writeShredding.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def materialize(df):
    """Cut lineage: write ``df`` to the shared checkpoint folder and return the reloaded frame.

    Used between warehouse layers built in memory, so each layer's plan starts from stored data
    instead of re-embedding every upstream layer (plans would otherwise grow with each layer and
    upstream work would be recomputed per reference).
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)

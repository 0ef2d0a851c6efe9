"""Session helpers: building a session for tests/bench and finding shared scratch space.

Library functions never create sessions; they take DataFrames (or a session passed in).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str | None = None, app: str = "statmart", shuffle_partitions: int = 8,
                  extra: dict | None = None) -> SparkSession:
    """Session for tests and the bench. On a cluster use the cluster's own session instead."""
    b = (
        SparkSession.builder.master(master or "local[8]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # checkpoint files of DataFrames that are no longer referenced are removed
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", "8g")
    )
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    Only when it is unset *and* Spark runs in local mode (tests) do we set our own;
    a cluster without a shared folder configured is an error, never a silent local path.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - a Spark Connect session: the server owns the setting
        conf_dir = spark.conf.get("spark.checkpoint.dir", None)
        if not conf_dir:
            raise RuntimeError("spark.checkpoint.dir must name a shared folder")
        return conf_dir
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    local = tempfile.mkdtemp(prefix="statmart-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder (never a machine-local temp dir)."""
    base = spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)
    base = base.rstrip("/")
    return f"{base}/statmart-scratch/{name}-{uuid.uuid4().hex[:12]}"


#: Spark's own setting (4.1 on; older ones ignore it): a statement's shuffle files are removed at its end.
_SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df, name: str):
    """Write ``df`` once as parquet under the shared checkpoint folder and read it back.

    Cuts the lineage like ``checkpoint()`` but computes the input once, and later reads
    get column pruning and filter pushdown on the written files. The shuffle files of the write
    are of no further use and go as soon as it ends.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(_SHUFFLE_CLEANUP, None)
    spark.conf.set(_SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(_SHUFFLE_CLEANUP) if before is None else spark.conf.set(_SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)  # known: no job to look it up


#: Rows that ``settled`` may hold on the driver.
FEW_ROWS = 10_000


def settled(df, name: str, rows: int = FEW_ROWS):
    """``df`` computed once: as a local table if it has at most ``rows`` rows, else written."""
    found = df.take(rows + 1)
    if len(found) > rows:
        return materialize(df, name)
    return df.sparkSession.createDataFrame([tuple(r) for r in found], df.schema)


def default_parallelism(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "8")))


__all__ = ["build_session", "ensure_checkpoint_dir", "scratch_path", "materialize", "settled", "default_parallelism"]

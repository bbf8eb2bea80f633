"""Session helpers: a local session for tests/bench, and the shared scratch folder.

On a cluster the shared folder is whatever `spark.checkpoint.dir` names; we only
create our own when it is unset and the master is local (tests, bench).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("liftwise")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _context_or_none(spark: SparkSession):
    try:
        return spark.sparkContext
    except Exception:  # Spark Connect sessions expose no SparkContext
        return None


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers (once per application): they do not have the
    driver's import path, on a local master either."""
    sc = _context_or_none(spark)
    if sc is None or getattr(sc, "_liftwise_shipped", False):
        return
    import shutil

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="liftwise-zip-"), "liftwise")
    sc.addPyFile(shutil.make_archive(target, "zip", root, "liftwise"))  # served by the driver
    sc._liftwise_shipped = True


def app_key(spark: SparkSession) -> str:
    sc = _context_or_none(spark)
    return sc.applicationId if sc is not None else str(spark.conf.get("spark.app.id", id(spark)))


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a local one only in local mode."""
    sc = _context_or_none(spark)
    if sc is None:  # server-side session: the cluster's setting is the only option
        configured = spark.conf.get(CHECKPOINT_CONF, None)
        if not configured:
            raise RuntimeError(f"{CHECKPOINT_CONF} is not set on the server")
        return configured.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    configured = spark.conf.get(CHECKPOINT_CONF, None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                f"{CHECKPOINT_CONF} is not set; point it at a folder every executor shares"
            )
        configured = tempfile.mkdtemp(prefix="liftwise-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a written table under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    return f"{base}/tables/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable eager checkpoint into the shared folder named by `spark.checkpoint.dir`:
    the plan runs once (the forced checkpoint writes the partitions as they are
    computed), later stages read the files, and an executor loss does not replay the
    lineage. Never a local checkpoint."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def default_parallelism(spark: SparkSession) -> int:
    sc = _context_or_none(spark)
    if sc is not None:
        return int(sc.defaultParallelism)
    return int(spark.conf.get("spark.default.parallelism", os.environ.get("BENCH_CPUS", "8")))

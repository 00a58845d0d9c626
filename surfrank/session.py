"""Session helpers: checkpoint folder, shared scratch paths, job-scoped settings.

Lineage is cut with reliable ``checkpoint()`` into the folder the cluster names
in ``spark.checkpoint.dir``.  That folder is read from the session; a private
one is created only when none is configured *and* the master is local (tests,
benches).  On a cluster without a checkpoint folder the job refuses to start,
because a machine-local folder would not survive the loss of an executor.
"""

from __future__ import annotations

import contextlib
import tempfile
import uuid

from pyspark.sql import SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, creating a local one only in local mode."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="surfrank-ckpt-"))
        return sc.getCheckpointDir()
    raise RuntimeError(
        "spark.checkpoint.dir is not set: iterative ranking needs a shared, "
        "reliable folder (HDFS/S3/...) to cut lineage; set it on the session."
    )


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared checkpoint folder, for written intermediate tables."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/surfrank-{name}-{uuid.uuid4().hex[:12]}"


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


@contextlib.contextmanager
def job_conf(spark: SparkSession, settings: dict[str, str | None]):
    """Apply session SQL settings for the duration of a job and restore them after."""
    conf = spark.conf
    saved: dict[str, str | None] = {}
    for key, value in settings.items():
        if value is None:
            continue
        saved[key] = conf.get(key, None)
        conf.set(key, value)
    try:
        yield
    finally:
        for key, old in saved.items():
            if old is None:
                conf.unset(key)
            else:
                conf.set(key, old)


def local_session(app: str = "surfrank", cores: str = "*", partitions: int = 8) -> SparkSession:
    """Session for tests and benches: local master, UI off, AQE on."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )

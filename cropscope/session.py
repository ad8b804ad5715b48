"""Session helpers: building a session for tests/bench and locating shared storage."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(master: str | None = None, app: str = "cropscope",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Session for tests, bench and local runs.

    On a cluster the caller's own session is used instead; nothing in the
    library depends on this builder.
    """
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    master = master or f"local[{cpus}]"
    builder = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("CROPSCOPE_DRIVER_MEMORY", "8g"))
    )
    event_log = os.environ.get("CROPSCOPE_EVENT_LOG")  # stage/task times without the UI
    if event_log:
        os.makedirs(event_log, exist_ok=True)
        builder = (builder.config("spark.eventLog.enabled", "true")
                   .config("spark.eventLog.dir", event_log))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str | None:
    """The shared folder the cluster names in ``spark.checkpoint.dir``, if any."""
    conf = spark.sparkContext.getConf()
    value = conf.get(CHECKPOINT_CONF, None)
    if not value:
        try:
            value = spark.conf.get(CHECKPOINT_CONF, None)
        except Exception:  # pragma: no cover - conf lookups never fail in practice
            value = None
    if not value:
        value = spark.sparkContext.getCheckpointDir()
    return value or None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a local one only when unset.

    A cluster names its shared folder in ``spark.checkpoint.dir``; that value
    always wins. Only a local session without one (tests, local runs) gets a
    fresh scratch folder; a cluster session without one is an error.
    """
    root = checkpoint_root(spark)
    if root:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(root)
        return root
    if not spark.sparkContext.master.startswith("local"):
        # a folder on the driver's disk is not visible to executors
        raise RuntimeError("set spark.checkpoint.dir to a folder on shared storage")
    root = tempfile.mkdtemp(prefix="cropscope-ckpt-")
    spark.conf.set(CHECKPOINT_CONF, root)
    spark.sparkContext.setCheckpointDir(root)
    return root


def shared_path(spark: SparkSession, *parts: str, unique: bool = True) -> str:
    """A fresh path below the shared checkpoint folder (for written tables, stream
    checkpoints and sinks). ``unique`` appends a random component so repeated
    calls never collide."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    tail = list(parts)
    if unique:
        tail.append(uuid.uuid4().hex[:12])
    return "/".join([root, "cropscope", *tail])


def materialize(df, name: str):
    """Write ``df`` once as Parquet below the shared checkpoint folder and read
    it back: cuts lineage like ``checkpoint()`` but computes the plan only once
    (an eager checkpoint of an unpersisted plan runs it twice), and survives a
    lost executor because the files live on shared storage."""
    path = shared_path(df.sparkSession, "tables", name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)

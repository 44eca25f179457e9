"""Session helpers: build a session for tests/bench, locate the shared checkpoint root."""

from __future__ import annotations

import hashlib
import io
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Session settings we rely on. Timestamps are UTC everywhere; AQE re-plans
# joins and coalesces shuffle partitions at runtime; skew-join splitting is on.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "corpusflow", conf: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the settings above. Used by tests and bench."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is the shared file system every executor sees, and it has
    to be set there: a machine-local folder would lose data with its machine. Only
    a local master without the setting (tests, a laptop) gets a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if not root:
        if not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = sc.getCheckpointDir() or tempfile.mkdtemp(prefix="corpusflow-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh sub-folder of the checkpoint root (for snapshots and stream checkpoints)."""
    return "/".join([checkpoint_root(spark), "corpusflow", *parts, uuid.uuid4().hex])


def sf_dir_default() -> str:
    return os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")


def ensure_parallel(df, factor: int = 2):
    """Spread a frame over the cluster before a CPU-heavy narrow stage (Python UDF,
    regex-heavy parsing) when its input is so small that a scan gets fewer splits than
    there are task slots: Spark packs at least ``openCostInBytes`` (4 MB, each file
    counted with that much on top) into a split. This is decided on the plan's size
    estimate and file list, nothing is planned or run for it, and what is shuffled is
    at most that much per slot; larger inputs and streams are left alone."""
    if df.isStreaming:
        return df
    try:
        slots = df.sparkSession.sparkContext.defaultParallelism
        unit = df.sparkSession._jsparkSession.sessionState().conf().filesOpenCostInBytes()
        size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except (AttributeError, TypeError):  # no JVM plan at hand (e.g. Spark Connect): keep the plan as is
        return df
    if size >= slots * unit or len(df.inputFiles()) >= slots:
        return df
    return df.repartition(slots * factor)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``corpusflow`` importable on the executors' Python workers (like
    ``--py-files``): zip the package once per SparkContext and ``addPyFile`` it."""
    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    data = buf.getvalue()
    name = f"corpusflow-{hashlib.sha1(data).hexdigest()[:16]}.zip"
    out = f"{checkpoint_root(spark)}/corpusflow/code/{name}"  # written through the session's Hadoop file system
    path = sc._jvm.org.apache.hadoop.fs.Path(out)
    fs = path.getFileSystem(sc._jsc.hadoopConfiguration())
    if not fs.exists(path):
        stream = fs.create(path, True)
        stream.write(bytearray(data))
        stream.close()
    sc.addPyFile(out)
    _SHIPPED.add(key)


def broadcast_if_small(df, max_rows: int = 100_000):
    """Broadcast ``df`` only after checking it has at most ``max_rows`` rows (a
    bounded count); beyond that the join stays a shuffle join."""
    from pyspark.sql import functions as F

    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df

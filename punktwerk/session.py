"""Session helpers: building a session for tests/bench and locating the
shared scratch folder (``spark.checkpoint.dir``)."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app: str = "punktwerk") -> SparkSession:
    """Session for tests and the bench. On a cluster, the cluster's own
    session is used instead and none of these settings are forced."""
    master = master or f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    spark = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the session.

    The cluster names it in ``spark.checkpoint.dir``; only when it is unset
    (local tests) do we create one, and only for a local master.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if not d:
        d = spark.conf.get("spark.checkpoint.dir", None)
        if not d:
            if not sc.master.startswith("local"):
                raise RuntimeError(
                    "spark.checkpoint.dir is not set; a shared folder is "
                    "required on a cluster")
            d = tempfile.mkdtemp(prefix="punktwerk-ckpt-")
        sc.setCheckpointDir(d)
        d = sc.getCheckpointDir() or d
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder for
    intermediate tables and files written by a job."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/punktwerk/{name}-{uuid.uuid4().hex[:12]}"
    if not _SCRATCH:
        atexit.register(drop_scratch)
    _SCRATCH.append(path)
    return path


_SCRATCH: list[str] = []


def drop_scratch() -> None:
    """Delete the scratch tables of this driver. Results that are read lazily
    from them must be finished; runs by itself when the driver ends."""
    spark = SparkSession.getActiveSession()
    if spark is None or spark.sparkContext._jsc is None:
        return
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    while _SCRATCH:
        p = jvm.org.apache.hadoop.fs.Path(_SCRATCH.pop())
        p.getFileSystem(conf).delete(p, True)


_SHIPPED: set = set()


def ship_package(spark: SparkSession | None = None) -> None:
    """Make ``punktwerk`` importable in the Python workers (pandas UDFs,
    applyInPandas, mapInArrow) by adding a zip of the package with
    ``addPyFile``, once per SparkContext -- what ``--py-files`` does. The zip
    is built on the driver and distributed by Spark itself."""
    import zipfile
    spark = spark or SparkSession.getActiveSession()
    if spark is None:
        return
    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="punktwerk-pyfiles-"), "punktwerk.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(out)
    _SHIPPED.add(key)

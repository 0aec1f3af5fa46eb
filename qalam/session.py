"""Session helpers: a tuned local session for tests/bench and checkpoint-dir discovery.

On a cluster the caller owns the session; the library only reads settings from it.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "qalam") -> SparkSession:
    """A local session configured like the tests and the bench expect."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("QALAM_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for reliable checkpoints and intermediate tables.

    Uses the directory the cluster names in ``spark.checkpoint.dir`` (or one already set on the
    context). Only when nothing is set *and* the master is local (tests, bench) a fresh temporary
    folder is created; on a cluster an unset directory is an error, never a machine-local path.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir() or conf_dir
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="qalam-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for a written intermediate table."""
    import uuid

    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/qalam-{name}-{uuid.uuid4().hex[:12]}"


_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def dropping_shuffles(spark: SparkSession) -> Iterator[None]:
    """Writes inside remove their shuffle files when they end. Else those stay on the executors' disks until
    the driver's garbage collector happens to meet the plan, beside the table that was written from them."""
    before = spark.conf.get(_DROP_SHUFFLES, None)
    spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_DROP_SHUFFLES)
        else:
            spark.conf.set(_DROP_SHUFFLES, before)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``qalam`` importable in Python workers (Arrow UDFs) via ``addPyFile`` once per context.

    Only for local masters (tests, bench), where workers do not see the driver's ``sys.path``.
    On a cluster the package is shipped with the job (``--py-files`` / ``spark.submit.pyFiles``)
    and nothing is written to a machine-local folder, unless ``spark.qalam.shipPackage=true``.
    """
    import importlib.util
    import zipfile

    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    if not sc.master.startswith("local") and spark.conf.get("spark.qalam.shipPackage", "false") != "true":
        _SHIPPED.add(key)
        return
    if importlib.util.find_spec("qalam") is None:  # pragma: no cover
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    fd, path = tempfile.mkstemp(prefix="qalam-pkg-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as zf:
        for dirpath, _dirs, files in os.walk(pkg_dir):
            if "__pycache__" in dirpath:
                continue
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    zf.write(full, os.path.relpath(full, root))
    sc.addPyFile(path)
    _SHIPPED.add(key)


def balance(df, min_partitions: int | None = None):
    """Round-robin repartition only when the input has fewer partitions than the cluster can
    run at once (e.g. one large unsplittable file). Large inputs already arrive as many splits
    and pass through untouched, so no shuffle is added at scale."""
    spark = df.sparkSession
    want = min_partitions or spark.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < want:
        return df.repartition(want)
    return df

"""Spark session helpers and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid

from pyspark.sql import SparkSession


def get_spark(master: str | None = None, cores: int | None = None,
              shuffle_partitions: int | None = None, app: str = "loamflow",
              extra: dict | None = None) -> SparkSession:
    """Session for local runs and tests. On a cluster, pass nothing and keep its settings."""
    cores = cores or int(os.environ.get("BENCH_CPUS", "8"))
    master = master or f"local[{cores}]"
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.driver.memory", os.environ.get("LOAMFLOW_DRIVER_MEMORY", "8g"))
         .config("spark.sql.streaming.stopActiveRunOnRestart", "true")
         # local file system: stat a micro-batch's files (<= 3000) on the driver instead of
         # launching a listing job; clusters on object stores keep Spark's default (32)
         .config("spark.sql.sources.parallelPartitionDiscovery.threshold", "3000"))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_root(spark: SparkSession) -> str:
    """Shared folder named by ``spark.checkpoint.dir``. Only a local master, whose executors
    are the driver, gets a temporary one when that is unset."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="loamflow-")
        spark.conf.set("spark.checkpoint.dir", root)
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def new_run_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder below the shared work root; never reused, never cleared."""
    return f"{work_root(spark)}/loamflow/{label}-{uuid.uuid4().hex[:12]}"


_SHIPPED: set[int] = set()
_SHIP_LOCK = threading.Lock()


def ship_package(spark: SparkSession) -> None:
    """Make ``loamflow`` importable in Python workers (once per SparkContext), the same
    way ``--py-files`` does: the package is zipped into the shared work folder and added
    with ``addPyFile``. Harmless when the package is installed on the workers."""
    sc = spark.sparkContext
    key = id(sc._jsc) if getattr(sc, "_jsc", None) is not None else id(sc)
    with _SHIP_LOCK:
        if key not in _SHIPPED:
            _ship(spark, sc)
            _SHIPPED.add(key)


def _ship(spark: SparkSession, sc) -> None:
    import hashlib
    import io
    import zipfile

    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for base, dirs, files in sorted(os.walk(pkg_dir)):
            dirs.sort()
            for f in sorted(files):
                if f.endswith(".py"):
                    full = os.path.join(base, f)
                    info = zipfile.ZipInfo(os.path.relpath(full, os.path.dirname(pkg_dir)))
                    with open(full, "rb") as fh:
                        z.writestr(info, fh.read())
    data = buf.getvalue()
    digest = hashlib.sha1(data).hexdigest()[:16]
    from .sources import storage

    target = f"{work_root(spark)}/loamflow/_pyfiles/loamflow-{digest}.zip"
    if not storage.exists(spark, target):
        storage.write(spark, target, data)
    sc.addPyFile(target)

"""Session helpers: a sane local session for tests and a shared scratch folder.

On a cluster the session is built by the launcher; the library only reads
``spark.checkpoint.dir`` from it.  A folder of our own is chosen only where the
setting is unset (local runs and tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "nestgate") -> SparkSession:
    """Local session used by tests and the benchmark (UI off, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("NESTGATE_DRIVER_MEMORY", "8g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session; only when it is unset in a local run (tests) a fresh
    folder is created and registered, so lineage cuts and scratch tables work.
    On a cluster an unset folder is an error: a machine-local one is not shared.
    """
    try:
        sc = spark.sparkContext          # not available on a Spark Connect session
    except Exception:  # noqa: BLE001
        sc = None
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root and sc is not None:
        root = sc.getCheckpointDir()
    if not root:
        master = spark.conf.get("spark.master", "") or ""
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="nestgate-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the executors, once a session, where ``PYTHONPATH`` does not already lead to it.

    Python workers then import it whatever folder the driver was started in.  The archive is made on
    the driver and distributed by Spark; executors read their own copy."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001  (a Spark Connect session)
        return
    root = Path(__file__).resolve().parent.parent
    on_path = [os.path.abspath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    if str(root) in on_path or getattr(sc, "_nestgate_shipped", False):
        return
    archive = Path(tempfile.mkdtemp(prefix="nestgate-ship-")) / "nestgate.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted((root / "nestgate").rglob("*.py")):
            z.write(f, f.relative_to(root))
    sc.addPyFile(str(archive))
    sc._nestgate_shipped = True


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under the shared checkpoint folder; removed when the application ends."""
    root = checkpoint_root(spark)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001
        sc = None
    if sc is None:
        return f"{root}/nestgate/{name}-{uuid.uuid4().hex[:12]}"
    folder = f"{root}/nestgate/{sc.applicationId}"
    path = sc._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(sc._jsc.hadoopConfiguration())
    if fs.mkdirs(path):
        fs.deleteOnExit(path)
    return f"{folder}/{name}-{uuid.uuid4().hex[:12]}"

"""Session construction and the shared working folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
ARCHIVE = "traceframe-package.zip"


def local_session(name: str = "traceframe", cpus: str = "8", **conf: str) -> SparkSession:
    """A local session for tests and the bench. Cluster jobs bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers of a session, unless they find it already.

    Workers see what is on PYTHONPATH (or installed) and what a session has sent; the path of
    the driver's program is not enough, as soon as it runs from another folder.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    context = spark.sparkContext
    if root in map(os.path.abspath, filter(None, os.environ.get("PYTHONPATH", "").split(os.pathsep))) or "site-packages" in root:
        return
    if any(f.endswith(ARCHIVE) for f in context.listFiles):
        return
    folder = tempfile.mkdtemp(prefix="traceframe-package-")  # the driver serves the archive from here to the end
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    path = os.path.join(folder, ARCHIVE)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
        for at, folders, files in os.walk(os.path.join(root, "traceframe")):
            folders[:] = [f for f in folders if f != "__pycache__"]
            for name in files:
                if name.endswith(".py"):
                    out.write(os.path.join(at, name), os.path.relpath(os.path.join(at, name), root))
    context.addPyFile(path)


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path all executors can reach, below the configured checkpoint folder.

    Only a local master may fall back to a temporary folder of this machine; on
    a cluster a missing setting is an error, never a silent local path.
    """
    base = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(CHECKPOINT_KEY)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"{CHECKPOINT_KEY} must name a shared folder on a cluster")
        base = _local_base()
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


_BASE: str | None = None


def _local_base() -> str:
    global _BASE
    if _BASE is None or not os.path.isdir(_BASE):
        _BASE = tempfile.mkdtemp(prefix="traceframe-")
    return _BASE


def cut_lineage(df, purpose: str = "table"):
    """Write ``df`` to the shared folder and read it back: a reliable lineage cut."""
    path = shared_folder(df.sparkSession, purpose)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

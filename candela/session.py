"""Session helpers.

The library never assumes a machine-local scratch folder on a cluster: lineage
cuts and round-trip writes go under ``spark.checkpoint.dir`` read from the
session. Only when that setting is absent (local tests) is a fresh temporary
folder taken and set.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.driver.memory": "16g",
}


def get_spark(master: str | None = None, app: str = "candela", **conf: str) -> SparkSession:
    """A session. The master and the number of shuffle partitions are the caller's: without them the launcher's hold."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULT_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and written intermediate tables.

    Reads ``spark.checkpoint.dir`` from the session; sets a fresh one only
    where it is unset in a local run. On a cluster executors would each write
    to a disk of their own, so there the setting must be given.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        master = spark.conf.get("spark.master", "local")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="candela-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    try:
        if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
            spark.sparkContext.setCheckpointDir(path)
    except Exception:  # noqa: BLE001 - no SparkContext access (e.g. Spark Connect)
        pass
    return path.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the checkpoint root for one written table."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Makes ``candela`` importable in Python workers (pandas UDFs, stateful processors).

    Zips the package once per application into the checkpoint root and adds it
    with ``addPyFile``, which distributes it to every executor.
    """
    import os
    import sys
    import zipfile

    from pyspark import cloudpickle

    # Runners that do not see added files (the driver-side pre-init of
    # transformWithState) still unpickle the processor: ship our classes by value.
    cloudpickle.register_pickle_by_value(sys.modules["candela"])
    try:
        sc = spark.sparkContext
        app = sc.applicationId
    except Exception:  # noqa: BLE001 - no SparkContext access (e.g. Spark Connect)
        return
    if app in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    target = scratch_path(spark, "pyfiles")
    if target.startswith("/") or target.startswith("file:"):
        local = target.removeprefix("file:")
        os.makedirs(local, exist_ok=True)
    else:
        # a remote checkpoint root (hdfs://, s3a://, ...): the zip is a driver-side
        # artifact that addPyFile ships to the executors, so a driver folder suffices
        local = tempfile.mkdtemp(prefix="candela-pyfiles-")
    zpath = f"{local}/candela.zip"
    with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as zf:
        for base, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(base, f)
                    zf.write(full, os.path.relpath(full, root))
    sc.addPyFile(zpath)
    _SHIPPED.add(app)

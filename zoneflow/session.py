"""Session construction and shared scratch locations.

Scratch data (stage outputs, landing-zone stand-ins) always lives under the
session's ``spark.checkpoint.dir`` -- the shared folder a cluster names for
durable intermediate data.  A cluster session without that setting is an error;
only a local master (tests, a laptop), where the driver is the only machine, gets
a folder of its own.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_LOCAL_DEFAULTS = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.ansi.enabled": "true",
}


def build_session(master: str = "local[8]", app: str = "zoneflow", **conf: str) -> SparkSession:
    """SparkSession for local runs and tests (clusters bring their own)."""
    builder = SparkSession.builder.master(master).appName(app)
    for key, value in {**_LOCAL_DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session; one of its own only on a local master."""
    sc = spark.sparkContext
    root = sc.getCheckpointDir()
    if not root:
        root = sc.getConf().get("spark.checkpoint.dir", None)
        if root:
            sc.setCheckpointDir(root)
    if not root:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="zoneflow-ckpt-")
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir() or root
    return root.rstrip("/")


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers once per application (``--py-files`` does the same)."""
    context = spark.sparkContext
    if getattr(context, "_zoneflow_shipped", False):
        return
    top = Path(__file__).resolve().parent
    name = os.path.join(tempfile.mkdtemp(prefix="zoneflow-"), "zoneflow_package.zip")
    with zipfile.ZipFile(name, "w") as z:
        for f in sorted(top.rglob("*.py")):
            z.write(f, f.relative_to(top.parent))
    context.addPyFile(name)
    context._zoneflow_shipped = True


def scratch_dir(spark: SparkSession, tag: str) -> str:
    """A fresh, never-reused folder below the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/zoneflow/{tag}-{uuid.uuid4().hex[:12]}"

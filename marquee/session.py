"""Spark session settings and the shared scratch folder."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import SparkSession

# Settings the operators are written for. All are Spark defaults or safe on any
# cluster; a deployment sets partition counts and memory for its own size.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "static",
}


def local_session(app: str = "marquee", cores: int | str = "*", partitions: int = 8,
                  memory: str = "8g") -> SparkSession:
    """A session for one machine: tests, benchmarks, notebooks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
    )
    for key, value in RECOMMENDED.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the recommended settings to a session that someone else has made."""
    for key, value in RECOMMENDED.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named in ``spark.checkpoint.dir``.

    Only a local master may go without the setting; it then gets a temporary folder,
    which is also set as the checkpoint folder of the context.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    folder = context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="marquee-"))
    return context.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder, in a folder of this application's own.

    What is stored there is of no use once the application has ended.
    """
    application = spark.sparkContext.applicationId
    return f"{shared_dir(spark)}/{application}/{label}-{uuid.uuid4().hex}"


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package, wherever the driver was started.

    Nothing is sent where the workers find it anyway: in their folder or on PYTHONPATH.
    """
    root = Path(__file__).resolve().parents[1]
    found = [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)]
    application = spark.sparkContext.applicationId
    if application in _shipped or str(root) in map(os.path.realpath, filter(None, found)):
        return
    folder = tempfile.mkdtemp(prefix="marquee-package-")
    spark.sparkContext.addPyFile(
        shutil.make_archive(f"{folder}/marquee_package", "zip", root, root.joinpath("marquee").name)
    )
    _shipped.add(application)

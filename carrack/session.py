"""Session set-up and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def session(app: str = "carrack", master: str | None = None, **conf: object) -> SparkSession:
    """Return a session with the settings the operators are written for.

    Partition counts are left to AQE: ``spark.sql.shuffle.partitions`` is only the
    upper bound that it coalesces from, so a cluster should raise it with the data.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    settings.update({key: str(value) for key, value in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder that intermediate tables are written to.

    It is the cluster's ``spark.checkpoint.dir``.  Only a local master may fall back
    to a temporary folder, because other machines could not see it.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="carrack-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below :func:`scratch_root`; nothing exists there yet."""
    return f"{scratch_root(spark)}/carrack-{label}-{uuid.uuid4().hex}"


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package, once per application, through Spark's own file server."""
    context = spark.sparkContext
    if getattr(context, "_carrack_shipped", False):
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="carrack-code-")) / "carrack.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as target:
        for file in sorted(root.rglob("*.py")):
            target.write(file, f"{root.name}/{file.relative_to(root)}")
    context.addPyFile(str(archive))
    context._carrack_shipped = True

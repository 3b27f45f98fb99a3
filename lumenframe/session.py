"""Session settings that the operators are designed for."""
from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

SHIPPED = "lumenframe.shipped"


def build_session(app: str = "lumenframe", master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """A session with adaptive execution on; partition count follows the cluster unless given."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            builder = builder.config("spark.driver.memory", os.environ.get("LUMEN_DRIVER_MEMORY", "12g"))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once per application, so that functions defined in it can be loaded there."""
    if spark.conf.get(SHIPPED, None) == spark.sparkContext.applicationId:
        return
    root = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="lumenframe-")) / "lumenframe.zip"
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(target))
    spark.conf.set(SHIPPED, spark.sparkContext.applicationId)

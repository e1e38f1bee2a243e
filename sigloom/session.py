"""Sessions, and shipping this package to executors."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()
BATCH_ROWS = 1024


def local_session(cores: str = "8", app: str = "sigloom", **conf: str) -> SparkSession:
    """A one-machine session for tests and the bench."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    settings = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false",
    } | conf
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship(spark: SparkSession) -> SparkSession:
    """Gives the executors this package, once an application, so that functions pickled by
    reference are found there whether or not it is installed on the machines. Batches between Spark
    and Python are kept to BATCH_ROWS, as rows with whole texts are wide."""
    context = spark.sparkContext
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    if context.applicationId not in _shipped:
        root = Path(__file__).resolve().parent
        target = os.path.join(tempfile.mkdtemp(prefix="sigloom-"), "sigloom_package.zip")
        with zipfile.ZipFile(target, "w") as archive:
            for path in sorted(root.rglob("*.py")):
                archive.write(path, path.relative_to(root.parent))
        context.addPyFile(target)
        _shipped.add(context.applicationId)
    return spark

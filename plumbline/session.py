"""Session settings the operators rely on."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # the last of a repeated member name wins, as in JavaScript
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings to a running session."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return ship(spark)


def ship(spark: SparkSession) -> SparkSession:
    """Send this package to the executors, once per application, so that they need not have it installed."""
    context = spark.sparkContext
    if not getattr(context, "plumbline_shipped", False):
        package = Path(__file__).resolve().parent
        archive = Path(tempfile.mkdtemp(prefix="plumbline-code-")) / "plumbline.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for source in sorted(package.rglob("*.py")):
                out.write(source, Path(package.name) / source.relative_to(package))
        context.addPyFile(str(archive))
        context.plumbline_shipped = True
    return spark

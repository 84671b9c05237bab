"""The package's own code on the executors."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

PACKAGE = Path(__file__).resolve().parents[1]
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package to the executors' Python workers, once per application.

    Spark copies the archive to every executor, also to one that joins later;
    the driver's folder is only where it is made.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    archive = Path(tempfile.mkdtemp(prefix="martloom-code-")) / f"{PACKAGE.name}.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for source in sorted(PACKAGE.rglob("*.py")):
            out.write(source, source.relative_to(PACKAGE.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)

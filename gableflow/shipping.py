"""Send this package's source to the executors, so that Python workers can import it wherever they run."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_sent: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Add the package to the session's Python files, once for each Spark application."""
    context = spark.sparkContext
    if context.applicationId in _sent:
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="gableflow-")) / "gableflow_source.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, path.relative_to(root.parent).as_posix())
    context.addPyFile(str(archive))
    _sent.add(context.applicationId)

"""Send this package to the executors."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SENT: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Have Spark hand the package's files to all executors, once per application."""
    context = spark.sparkContext
    package = Path(__file__).parent.parent
    if context.applicationId in _SENT or not package.is_dir():
        return
    made = Path(tempfile.mkdtemp(prefix="firmscope-")) / "firmscope_package.zip"
    with zipfile.ZipFile(made, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(made))
    _SENT.add(context.applicationId)

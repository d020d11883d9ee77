"""Makes the package importable in the executors' Python workers."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent


def ship(spark: SparkSession) -> None:
    """Send the package to the executors, once for each Spark context.

    Nothing is sent where the workers' PYTHONPATH has it already.
    """
    context = spark.sparkContext
    if getattr(context, "_orilla_shipped", False):
        return
    context._orilla_shipped = True
    if str(ROOT.parent) in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        return
    folder = tempfile.mkdtemp(prefix="orilla_")  # on the driver, which serves it to the executors
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    path = f"{folder}/orilla_package.zip"
    with zipfile.ZipFile(path, "w") as z:
        for p in sorted(ROOT.rglob("*.py")):
            z.write(p, str(p.relative_to(ROOT.parent)))
    context.addPyFile(path)

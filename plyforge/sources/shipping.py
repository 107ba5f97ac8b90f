"""The library's own code for executors that do not have its folder."""

import os
import tempfile
import zipfile
from functools import cache

from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@cache
def _packed() -> str:
    path = os.path.join(tempfile.mkdtemp(prefix="plyforge-"), "plyforge.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for package in ("plyforge", "checks"):
            for folder, _, names in os.walk(os.path.join(ROOT, package)):
                for name in (n for n in names if n.endswith(".py")):
                    file = os.path.join(folder, name)
                    archive.write(file, os.path.relpath(file, ROOT))
    return path


@cache
def _ship(application: str) -> None:
    SparkSession.active().sparkContext.addPyFile(_packed())


def ship_library(spark: SparkSession) -> None:
    """Sends the packages to the executors, once for each application."""
    _ship(spark.sparkContext.applicationId)

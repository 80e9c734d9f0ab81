"""The package on the executors' path."""

from __future__ import annotations

import functools
import importlib.util
import os
import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per application, unless their
    path has it already (PYTHONPATH of the driver is that of its workers)."""
    package = Path(__file__).resolve().parents[1]
    app = spark.sparkContext.applicationId
    paths = [Path(p).resolve() for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    if app in _SHIPPED or package.parent in paths or importlib.util.find_spec(package.name) is None:
        return
    _SHIPPED.add(app)
    archive = Path(tempfile.mkdtemp(prefix="millrace-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(archive))


def shipped(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """``f``, with the package sent ahead."""

    @functools.wraps(f)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return f(spark, sf_dir)

    return run

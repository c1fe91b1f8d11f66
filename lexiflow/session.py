"""Sessions, and this package on the executors."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent
_shipped: set[str] = set()


def session(name: str = "lexiflow", **conf: str) -> SparkSession:
    """A session with what the queries rely on: UTC, adaptive execution with skewed joins split."""
    own = {"spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true"}
    return SparkSession.builder.appName(name).config(map=own | {k.replace("__", "."): v for k, v in conf.items()}).getOrCreate()


def ship(spark: SparkSession) -> None:
    """Lets Python workers import this package; they already can where PYTHONPATH has it."""
    if str(ROOT.parent) in os.environ.get("PYTHONPATH", "").split(os.pathsep) or (app := spark.sparkContext.applicationId) in _shipped:
        return
    target = Path(tempfile.mkdtemp(prefix="lexiflow-")) / "lexiflow.zip"
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted(ROOT.rglob("*.py")):
            z.write(p, p.relative_to(ROOT.parent))
    spark.sparkContext.addPyFile(str(target))
    _shipped.add(app)

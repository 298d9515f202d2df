"""Sessions: settings that the plans count on, and the package on the executors."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_sent: set[str] = set()


def session(master: str = "local[8]", **settings: str) -> SparkSession:
    conf = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
    } | settings
    return SparkSession.builder.master(master).config(map=conf).getOrCreate()


def ship(spark: SparkSession) -> None:
    """Send this package's sources to the executors, once per application; needless where they can import it."""
    sc = spark.sparkContext
    if sc.applicationId in _sent:
        return
    root = Path(__file__).resolve().parent
    with tempfile.NamedTemporaryFile(prefix="quire-", suffix=".zip", delete=False) as f, zipfile.ZipFile(f, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, os.path.join("quire", p.relative_to(root)))
    sc.addPyFile(f.name)
    _sent.add(sc.applicationId)

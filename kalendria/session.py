"""Sessions, and the package on their executors."""

from __future__ import annotations

import atexit
import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SHIPPED: dict[str, str] = {}


def build(cores: str = "*", **conf: str) -> SparkSession:
    """A local session with the settings that results depend on."""
    b = SparkSession.builder.master(f"local[{cores}]").appName("kalendria").config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false")
    for k, v in conf.items():
        b = b.config(k.replace("__", "."), v)
    return b.getOrCreate()


def ship(spark: SparkSession) -> SparkSession:
    """Gives the package to Python workers wherever they run, once a context: they may not see the driver's folders."""
    sc = spark.sparkContext
    if sc.applicationId not in _SHIPPED:
        root = Path(__file__).resolve().parent
        fd, path = tempfile.mkstemp(prefix="kalendria-", suffix=".zip")
        os.close(fd)
        with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
            for f in sorted(root.rglob("*.py")):
                z.write(f, f.relative_to(root.parent))
        sc.addPyFile(os.path.realpath(path))
        _SHIPPED[sc.applicationId] = path
        atexit.register(Path(path).unlink, missing_ok=True)  # the file server reads it while the context lives
    return spark

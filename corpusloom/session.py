"""Sessions, and shipping this package to the executors' Python workers."""

from __future__ import annotations

import io
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent
_shipped: set[str] = set()


def local_session(cores: int | str = 8, memory: str = "8g", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("corpusloom")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship(spark: SparkSession) -> None:
    """Hand the package to the executors, once per application, so that workers can import it."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(ROOT.rglob("*.py")):
            z.write(p, p.relative_to(ROOT.parent))
    path = Path(tempfile.mkdtemp(prefix="corpusloom-ship-")) / f"{ROOT.name}.zip"  # read by the driver's file server only
    path.write_bytes(data.getvalue())
    spark.sparkContext.addPyFile(str(path))
    _shipped.add(app)

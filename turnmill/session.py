"""Session helpers: tables, shared folder, lineage cuts."""

from __future__ import annotations

import atexit
import os
import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


_shipped: set[str] = set()
_written: list[tuple] = []


def ship(spark: SparkSession | None = None) -> None:
    """Give this package to the Python workers, once for each application; without ``spark``, to those of the active session."""
    spark = spark or SparkSession.active()
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    home = Path(__file__).parent
    at = os.path.join(tempfile.mkdtemp(), f"{home.name}.zip")
    with zipfile.ZipFile(at, "w") as z:
        for p in sorted(home.rglob("*.py")):
            z.write(p, p.relative_to(home.parent))
    spark.sparkContext.addPyFile(at)  # served by the driver; the workers need no shared disk for it
    _shipped.add(app)


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The parquet table ``name`` under ``root`` (one file or a folder)."""
    ship(spark)
    return spark.read.parquet(f"{root}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors share, from ``spark.checkpoint.dir``.

    A folder of this machine is made only where the setting is missing and
    the master is local (tests); elsewhere a missing setting is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if found:
        return found.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    own = os.path.join(tempfile.gettempdir(), "turnmill-shared")
    os.makedirs(own, exist_ok=True)
    return f"file://{own}"


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder as parquet and read it back.

    Cuts the lineage so that a lost executor costs only the running stage,
    and lets several consumers share one computation. Compressed columns
    take far less room than checkpointed rows.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/cut-{uuid.uuid4().hex}"
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    _written.append((at, at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())))
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clean() -> None:
    """Delete the tables that ``cut`` wrote; results not yet computed cannot be read after it."""
    while _written:
        at, files = _written.pop()
        try:
            files.delete(at, True)
        except Exception:  # the JVM is gone: the folder is left to its owner
            return


atexit.register(clean)

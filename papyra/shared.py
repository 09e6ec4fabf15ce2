"""Shared storage: the one folder that driver and executors both see.

The place is ``spark.checkpoint.dir``; where that is unset a local session (tests) uses a temporary folder,
and a cluster, whose machines don't share one, gets an error. Lineage is cut with reliable checkpoints or with tables written there.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_local: dict[str, str] = {}
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package's code to the executors, once for an application; they need not have it installed."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    _shipped.add(sc.applicationId)
    package, folder = Path(__file__).parent, os.path.realpath(tempfile.mkdtemp(prefix="papyra-code-"))
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    with zipfile.ZipFile(f"{folder}/papyra_code.zip", "w") as z:
        for file in sorted(package.rglob("*.py")):
            z.write(file, file.relative_to(package.parent))
    sc.addPyFile(f"{folder}/papyra_code.zip")


def shared_root(spark: SparkSession) -> str:
    """URI of the shared folder of this session."""
    sc = spark.sparkContext
    ship(spark)
    root = sc.getConf().get(_SETTING) or spark.conf.get(_SETTING, None)
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError(f"set {_SETTING} to a folder that the driver and all executors share")
        root = _local.get(sc.applicationId) or _temporary(sc.applicationId)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def _temporary(application: str) -> str:
    """A folder for this process alone, removed at its end."""
    folder = os.path.realpath(tempfile.mkdtemp(prefix="papyra-"))
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    _local[application] = "file://" + folder
    return _local[application]


def shared_path(spark: SparkSession, tag: str) -> str:
    """A new, unused path in the shared folder."""
    return f"{shared_root(spark)}/{tag}-{uuid.uuid4().hex}"


def written(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = shared_path(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def filesystem(uri: str):
    """(pyarrow filesystem, path) of a URI, for workers that read or write files of the shared folder; a path without a scheme is local."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is something at ``path``, in whatever store Spark reaches it."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)


def input_bytes(df: DataFrame, column: str = "text") -> int:
    """Catalyst's estimate of the bytes of ``df``; where it has none (or no sensible one), ``column`` is measured."""
    from pyspark.sql import functions as F

    estimate = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return estimate if estimate < 1 << 50 else df.agg(F.sum(F.octet_length(F.col(column)))).first()[0] or 0

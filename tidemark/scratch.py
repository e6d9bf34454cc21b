"""Folders for intermediate tables: below ``spark.checkpoint.dir``, which all machines share."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_roots: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """A folder of this application's own below ``spark.checkpoint.dir``.

    Only where that is unset and the master is one machine, as in tests, a local temporary
    folder is used instead; on a cluster it is an error.  The folder goes when the driver's
    Python ends.
    """
    sc = spark.sparkContext
    if sc.applicationId not in _roots:
        base = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
        if not base:
            if not re.fullmatch(r"local(\[.*\])?", sc.master):
                raise ValueError(f"Set spark.checkpoint.dir to a folder that all machines of {sc.master} share")
            base = "file://" + tempfile.mkdtemp(prefix="tidemark-")
            sc.setCheckpointDir(base)
        _roots[sc.applicationId] = f"{base.rstrip('/')}/tidemark-{uuid.uuid4().hex}"
        atexit.register(_remove, spark, _roots[sc.applicationId])
    return _roots[sc.applicationId]


def _remove(spark: SparkSession, root: str) -> None:
    try:
        path = spark._jvm.org.apache.hadoop.fs.Path(root)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    except Exception:  # the JVM may be gone already: the folder then stays, as any checkpoint does
        pass


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the scratch folder."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the scratch folder and read it from there: its lineage ends."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    made = df.sparkSession.read.schema(df.schema).parquet(path)
    made._scratch_path = path
    return made


def discard(*tables: DataFrame) -> None:
    """Delete tables that :func:`materialise` wrote and nothing reads any more; other frames are left alone."""
    for df in tables:
        path = getattr(df, "_scratch_path", None)
        if path:
            spark = df.sparkSession
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)

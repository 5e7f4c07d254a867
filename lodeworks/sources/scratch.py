"""Intermediate tables in the folder that a cluster's executors share.

The folder is ``spark.checkpoint.dir``; one of our own is used only where that
setting is absent, as in a local test session.
"""

from __future__ import annotations

import tempfile
import uuid
import weakref

from pyspark.sql import DataFrame, SparkSession

from ..errors import require

_OWN: dict[str, str] = {}
_PATHS: dict[int, tuple] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; in a local session, where driver
    and executors are one machine, a temporary one if that is unset."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if found:
        return found.rstrip("/")
    require(spark.sparkContext.master.startswith("local"), "on a cluster spark.checkpoint.dir must name a shared folder")
    app = spark.sparkContext.applicationId
    if app not in _OWN:
        _OWN[app] = "file://" + tempfile.mkdtemp(prefix="lodeworks-")
    return _OWN[app]


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path (not yet created) for one run of one operator."""
    return f"{shared_dir(spark)}/lodeworks/{name}-{uuid.uuid4().hex}"


def stash(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    This cuts the lineage: a lost executor costs the files of running tasks
    only, since committed files stay in shared storage, and plans that use the
    table several times stay small.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _PATHS[id(out)] = (weakref.ref(out), path)
    return out


def drop(*tables: DataFrame) -> None:
    """Delete tables that :func:`stash` wrote, once nothing will read them;
    other DataFrames are left alone."""
    for df in tables:
        ref, path = _PATHS.pop(id(df), (None, None))
        if ref is not None and ref() is df:
            context = df.sparkSession.sparkContext
            p = context._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(context._jsc.hadoopConfiguration()).delete(p, True)

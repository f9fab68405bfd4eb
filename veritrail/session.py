"""Session settings and shipping of this package to the workers."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def session(app: str = "veritrail", **conf: str) -> SparkSession:
    """A session with the settings that the library's results rely on (UTC) or gain by (adaptive execution)."""
    builder = SparkSession.builder.appName(app).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true").config("spark.sql.adaptive.skewJoin.enabled", "true").config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship_package(spark: SparkSession) -> None:
    """Let the workers import this package, once for each context: as a small archive served by the driver."""
    context = spark.sparkContext
    if getattr(context, "_veritrail_shipped", False):
        return
    here = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="veritrail-"), "veritrail.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in os.walk(here):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(here)))
    context.addPyFile(archive)
    context._veritrail_shipped = True


def shared_folder(spark: SparkSession) -> str:
    """A folder that the driver and all executors see: spark.checkpoint.dir. Where it is unset, a local folder if all tasks run in this process, else an error."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    context = spark.sparkContext
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if getattr(context, "_veritrail_folder", None) is None:
        context._veritrail_folder = tempfile.mkdtemp(prefix="checkpoints-")
    return context._veritrail_folder


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever file system it is."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage by a checkpoint in the shared folder.

    Checkpoints go with the session; spark.cleaner.referenceTracking.cleanCheckpoints (which session() sets) removes them as soon as nothing refers to them.
    """
    context = df.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def once(df: DataFrame) -> DataFrame:
    """The same rows. Filters above it do not move below it, where the optimizer would copy costly columns into them, even into the
    functions that run for each element of an array."""
    return df.select(F.inline(F.array(F.struct(*(F.col(f"`{c}`") for c in df.columns)))))

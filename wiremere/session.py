"""Session settings and the shared scratch folder."""

import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import cache
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Java does not compile methods over 8000 bytes; past that, generated code is better split.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build(app: str = "wiremere", **extra: str) -> SparkSession:
    """A session with the settings results depend on; `extra` takes e.g. master or memory."""
    builder = SparkSession.builder.appName(app)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship_package(spark: SparkSession) -> None:
    """Give executors this package, once per application, through Spark's own file service."""
    package, context = Path(__file__).parent, spark.sparkContext
    name = f"{package.name}.zip"
    if not any(os.path.basename(p) == name for p in context._python_includes):
        base = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="wiremere-")), package.name)
        context.addPyFile(shutil.make_archive(base, "zip", package.parent, package.name))


@cache
def _own_dir() -> str:
    return tempfile.mkdtemp(prefix="wiremere-")


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir, which all executors share.

    A fresh local folder stands in for it where driver and executors are one process.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if spark.sparkContext.master.startswith("local") and not spark.sparkContext.master.startswith("local-cluster"):
        return _own_dir()
    raise ValueError("set spark.checkpoint.dir to a folder that all executors share")


_run_folder: ContextVar[str | None] = ContextVar("run_folder", default=None)


def scratch(spark: SparkSession, name: str) -> str:
    """A path of its own under the shared folder, or under the running job's part of it."""
    return f"{_run_folder.get() or shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a path with all below it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(target, True)


@contextmanager
def run_folder(spark: SparkSession) -> Iterator[str]:
    """One folder for all scratch tables of a run, removed at its end."""
    folder = scratch(spark, "run")
    token = _run_folder.set(folder)
    try:
        yield folder
    finally:
        _run_folder.reset(token)
        remove(spark, folder)


def materialise(df: DataFrame) -> DataFrame:
    """Compute once into a Parquet table in the shared folder and read it from there.

    Later reads neither repeat the work nor lose it with an executor, and they read only the
    columns and row groups they need.
    """
    path = scratch(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

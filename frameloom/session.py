"""Session and storage helpers that every part of the library shares."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Most rows that any side may have to be broadcast; with a few hundred bytes a row this stays far below the driver's memory.
BROADCAST_ROWS = 50_000

_shipped: set[str] = set()
_staged: list[tuple[SparkSession, str]] = []


def local_session(app: str = "frameloom", cores: str = "8", partitions: int = 8) -> SparkSession:
    """A session for tests and benchmarks on one machine; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("FRAMELOOM_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship(spark: SparkSession) -> None:
    """Sends this package to the Python workers of a session, once, so that they need no path to it."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    _shipped.add(context.applicationId)
    here = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="frameloom-package-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    path = os.path.join(folder, "frameloom.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for base, _, names in os.walk(here):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(base, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(here)))
    context.addPyFile(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: what the cluster names in spark.checkpoint.dir.

    Only where that is unset, as in tests on one machine, a temporary folder takes its place.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    made = tempfile.mkdtemp(prefix="frameloom-")
    atexit.register(shutil.rmtree, made, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(made)
    return spark.sparkContext.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """A reliable checkpoint in the shared folder; it survives the loss of executors."""
    ship(df.sparkSession)
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _delete(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # the session may be gone already
        pass


def _clean() -> None:
    for spark, path in _staged:
        _delete(spark, path)


atexit.register(_clean)


def stage(df: DataFrame, *partition_by: str) -> DataFrame:
    """Writes df as a columnar table into the shared folder and reads it back.

    Used instead of checkpoint() where a later step reads few of the columns or where compression matters.
    """
    spark = df.sparkSession
    ship(spark)
    path = f"{shared_dir(spark).rstrip('/')}/frameloom-{uuid.uuid4().hex}"
    df.write.partitionBy(*partition_by).parquet(path) if partition_by else df.write.parquet(path)
    _staged.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


def scratch(spark: SparkSession, name: str) -> str:
    """A path in the shared folder for files of a run; what lies there goes when the session ends."""
    path = f"{shared_dir(spark).rstrip('/')}/frameloom-{name}"
    _staged.append((spark, path))
    return path


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Marks df for broadcasting if it has at most so many rows; otherwise Spark picks a shuffle join."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def fixed_rows(df: DataFrame, most: int) -> list:
    """The rows of a table of settings; an error if it has more than most, as nothing may be left out."""
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"a table of settings has more than {most} rows")
    return rows

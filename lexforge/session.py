"""Session helpers: table readers, shared-folder checkpoints and size-checked broadcasts.

Nothing here starts a cluster; every function takes the caller's SparkSession.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark import SparkConf
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Largest number of rows of a side table that a broadcast hint may be put on.
BROADCAST_ROWS = 100_000


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("lexforge")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def session(memory: str = "8g") -> SparkSession:
    """The session that ``spark-submit`` or the surroundings configure; without a master, one on this machine."""
    if SparkSession.getActiveSession() is None and not SparkConf().contains("spark.master") and "MASTER" not in os.environ and "SPARK_REMOTE" not in os.environ:
        return local_session(memory=memory)
    return SparkSession.builder.appName("lexforge").config("spark.sql.session.timeZone", "UTC").getOrCreate()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once per context, so they need no installation of it."""
    context = spark.sparkContext
    if getattr(context, "_lexforge_shipped", False):
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="lexforge-"), "lexforge.zip")  # read by this driver only, which serves it
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, f"{root.name}/{p.relative_to(root)}")
    context.addPyFile(str(archive))
    context._lexforge_shipped = True


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """One Parquet table of a data directory."""
    ship(spark)
    return spark.read.parquet(f"{directory}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see: ``spark.checkpoint.dir``, or a temporary one where that is unset (tests, one machine)."""
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = context.getCheckpointDir()
    if current is None:
        if configured is None and not context.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(configured or tempfile.mkdtemp(prefix="lexforge-"))
        current = context.getCheckpointDir()
    return configured or current


def materialize(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    Cuts lineage like ``checkpoint()`` but stays columnar, so later reads prune columns. The files survive the loss of
    executors and are deleted when the session's file system closes.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop_path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if a count proves it has at most ``max_rows`` rows, else unchanged (shuffle join)."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def parallelism(spark: SparkSession) -> int:
    """Shuffle partitions of the session."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))

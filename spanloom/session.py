"""Session set-up and the folder that driver and executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, app: str = "spanloom") -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.driver.host", "127.0.0.1")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; where that is unset and the
    session is local (tests), a temporary folder that goes when Python exits."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    held = spark.sparkContext.getCheckpointDir()
    if held:
        return held.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    own = tempfile.TemporaryDirectory(prefix="spanloom-", ignore_cleanup_errors=True)
    atexit.register(own.cleanup)
    spark.sparkContext.setCheckpointDir("file://" + own.name)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder (not yet created)."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: lineage is
    cut, the plan above it runs once, and a lost executor loses nothing."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)

"""Session settings the operators rely on, and the shared folder for intermediate tables."""

import tempfile
import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

# Time zone: operators compare and truncate instants as UTC.
# Dynamic partition overwrite: re-running a load replaces only the partitions it touches.
# Call-site capture of every column expression only costs driver time.
SETTINGS = {
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "snappy",
}


def build_session(app_name: str = "emberlog", master: str | None = None, **extra: str) -> SparkSession:
    """Session with the settings above; ``extra`` adds or replaces single settings."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, for checkpoints and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``.  Only a local master, where one
    machine holds everything, falls back to a new temporary folder.
    """
    context = spark.sparkContext
    folder = (
        spark.conf.get("spark.checkpoint.dir", None)
        or context.getConf().get("spark.checkpoint.dir")
        or context.getCheckpointDir()
    )
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="emberlog-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """Unused path below the shared folder for one intermediate table."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


SMALL_ROWS = 100_000


def small_side(df, name: str, rows: int = SMALL_ROWS):
    """``df`` written once, and marked for broadcast only if it was counted to have few rows."""
    table = materialise(df, name)
    return F.broadcast(table) if table.limit(rows + 1).count() <= rows else table


def materialise(df, name: str):
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage at a table that outlives any executor, so columns whose value
    depends on how the data was partitioned stay the same for every later use.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)

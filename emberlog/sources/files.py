"""Small helpers around Spark file sources."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


# JSON keeps milliseconds unless told otherwise.
JSON_TIMES = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on whatever file system it names."""
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return system.exists(hadoop_path)


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder that its maker has no more use for."""
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def void_files(spark: SparkSession, path: str, endings: tuple[str, ...] = (".json", ".txt")) -> list[str]:
    """Files below a folder without a byte.

    Spark's file sources leave these out of every listing, so the file system is asked.
    """
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    # Not ``listFiles``: it asks for every file's permissions, which starts a process per local file.
    folders, found = [hadoop_path], []
    while folders:
        for status in system.listStatus(folders.pop()):
            if status.isDirectory():
                folders.append(status.getPath())
            elif not status.getLen() and status.getPath().getName().endswith(endings):
                found.append(status.getPath().toString())
    return found


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Parquet table, or an empty one with the schema when nothing was written yet."""
    if exists(spark, path):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


def evenly(frame: DataFrame, partitions: Sequence[str]) -> DataFrame:
    """Gather rows by output folder, with folders of any size split over several tasks.

    The rebalance hint lets the adaptive planner merge small folders into one task and cut
    a large one into files of the advised size, so there are neither many tiny files nor
    one task that writes a third of the data.
    """
    return frame.hint("rebalance", *partitions) if partitions else frame.hint("rebalance")


def write_table(
    frame: DataFrame,
    path: str,
    partitions: Sequence[str] = (),
    mode: str = "overwrite",
    fmt: str = "parquet",
    sort: Sequence[str] = (),
) -> int:
    """Write and return the number of rows, counted while writing.

    With partitions, ``overwrite`` replaces only the partitions present in ``frame``.
    """
    counter = Observation()
    out = evenly(frame, partitions)
    if sort:
        out = out.sortWithinPartitions(*partitions, *sort)
    out = out.observe(counter, F.count(F.lit(1)).alias("rows"))
    writer = out.write.mode(mode).format(fmt)
    if fmt == "parquet":
        writer = writer.option("compression", "snappy")
    elif fmt == "json":
        writer = writer.options(**JSON_TIMES)
    if partitions:
        writer = writer.partitionBy(*partitions).option("partitionOverwriteMode", "dynamic")
    writer.save(path)
    return counter.get["rows"]


def inventory(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Files below a path with size, time, raid and date; contents are not read."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .load(path)
        .select("path", "length", "modificationTime")
    )
    raid = F.regexp_extract("path", r"/(?:raid_id|raidid)=([^/]+)/", 1)
    date = F.regexp_extract("path", r"/(?:event_date|ingest_date)=([^/]+)/", 1)
    return files.withColumns({
        "raid_id": F.when(raid != "", raid),
        "date": F.when(date != "", date),
        "old_style": F.col("path").rlike("/raidid="),
    })


def layer_size(files: DataFrame) -> DataFrame:
    """Files and bytes per raid and date."""
    return files.groupBy("raid_id", "date").agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes")
    )


def prefix_audit(files: DataFrame) -> DataFrame:
    """Files per key style and raid: the older ``raidid=`` against ``raid_id=``."""
    style = F.when(F.col("old_style"), "raidid").when(F.col("raid_id").isNotNull(), "raid_id")
    return files.groupBy(F.coalesce(style, F.lit("none")).alias("style"), "raid_id").agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes")
    )


def latest_file(files: DataFrame) -> DataFrame:
    """The most recently modified file; equal times resolve to the larger path."""
    return files.agg(
        F.max_by("path", F.struct("modificationTime", "path")).alias("path"),
        F.max("modificationTime").alias("modificationTime"),
    )

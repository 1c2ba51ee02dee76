"""The typed event table, partitioned by raid and date."""

import warnings
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlog.operators.profile import partitions
from emberlog.operators.refine import as_silver
from emberlog.schemas import SILVER_PARTITIONS, SILVER_SCHEMA
from emberlog.sources.files import exists, inventory, read_or_empty, write_table


def write_silver(events: DataFrame, path: str, mode: str = "overwrite") -> dict:
    """Write Silver columns as Snappy Parquet below raid and date.

    Each row goes to the folder of its own raid and date.  ``overwrite`` replaces only the
    folders present in the load.  Rows are ordered by time inside each file.
    """
    rows = write_table(as_silver(events), path, SILVER_PARTITIONS, mode, sort=["timestamp"])
    return {"status": "success" if rows else "skipped", "rows": rows, "path": path}


def read_silver(spark: SparkSession, path: str) -> DataFrame:
    """All partitions with the fixed schema; raid and date come from the path."""
    table = spark.read.schema(SILVER_SCHEMA).option("mergeSchema", "false").parquet(path)
    return table.select(*SILVER_SCHEMA.names)


def read_silver_or_empty(spark: SparkSession, path: str) -> DataFrame:
    return read_or_empty(spark, path, SILVER_SCHEMA).select(*SILVER_SCHEMA.names)


def read_silver_partition(
    spark: SparkSession, path: str, raid_id: str, event_date: str, strict: bool = False
) -> DataFrame:
    """One partition, addressed by its folder, skipping unreadable files.

    Files that gave no row are counted in a warning; ``strict`` refuses them.  Raises
    ValueError when there is no such partition and RuntimeError when none of its files can
    be read.
    """
    folder = f"{path.rstrip('/')}/raid_id={raid_id}/event_date={event_date}"
    if not exists(spark, folder):
        raise ValueError(f"no Silver data for raid_id={raid_id}, event_date={event_date}")
    found = (
        spark.read.schema(SILVER_SCHEMA).option("basePath", path)
        .option("ignoreCorruptFiles", "true").parquet(folder)
    )
    listed = inventory(spark, folder, "*.parquet").count()
    read = found.select(F.col("_metadata.file_path")).distinct().count()
    where = f"raid_id={raid_id}, event_date={event_date}"
    if not read:
        raise RuntimeError(f"no readable Silver file for {where}")
    if read < listed:
        said = f"{listed - read} of {listed} Silver files of {where} gave no row"
        if strict:
            raise RuntimeError(said)
        warnings.warn(said, RuntimeWarning, stacklevel=2)
    return found.select(*SILVER_SCHEMA.names)


def silver_partitions(spark: SparkSession, path: str) -> DataFrame:
    """Sorted (raid, date) pairs present."""
    return partitions(read_silver(spark, path))


def touched_only(silver: DataFrame, events: DataFrame) -> DataFrame:
    """Silver rows in the partitions that ``events`` fall into.

    A semi join on the partition columns, so other folders are pruned at run time; rows
    without a raid or date match their like.
    """
    touched = events.select(*[F.col(c).alias(f"_{c}") for c in SILVER_PARTITIONS]).distinct()
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in SILVER_PARTITIONS]
    return silver.join(touched, reduce(Column.__and__, same), "left_semi")


def preview(silver: DataFrame, n: int = 3) -> DataFrame:
    """A few rows of key columns in a fixed order."""
    columns = ("event_id", "event_type", "timestamp", "damage_amount", "is_massive_hit")
    return silver.select(*columns).orderBy(F.col("timestamp"), F.col("event_id")).limit(n)

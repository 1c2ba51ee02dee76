"""The ids Silver holds, in hash buckets beside it.

Whether an event was seen before is a question about its id alone, whatever raid or date it
names.  The index answers it from one narrow column, and a micro-batch reads the buckets of
its own ids only, never the events stored.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emberlog.sources.files import exists, read_or_empty, write_table
from emberlog.sources.silver import read_silver

BUCKETS = 64
SCHEMA = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("load", T.StringType()),
    T.StructField("bucket", T.IntegerType()),
])


def index_path(silver: str) -> str:
    return f"{silver.rstrip('/')}_ids"


def bucket_of(event_id: Column) -> Column:
    return F.pmod(F.xxhash64(event_id), F.lit(BUCKETS)).cast("int")


def add_ids(events: DataFrame, index: str, load: str) -> int:
    """Append the ids of ``events``; an id that is added twice does no harm."""
    ids = events.select("event_id", F.lit(load).alias("load"), bucket_of(F.col("event_id")).alias("bucket"))
    return write_table(ids, index, ("bucket",), "append", sort=["event_id"])


def build_index(spark: SparkSession, silver: str, index: str) -> None:
    """An index of what Silver holds already; does nothing where there is one.

    Written into an unused folder, it also serves to gather the small files of many loads.
    """
    if not exists(spark, index) and exists(spark, silver):
        add_ids(read_silver(spark, silver), index, "")


def held_ids(spark: SparkSession, index: str, events: DataFrame) -> DataFrame:
    """Ids and loads of the buckets that the ids of ``events`` fall into.

    The bucket numbers, ``BUCKETS`` at most, become a filter on folders.
    """
    touched = [r[0] for r in events.select(bucket_of(F.col("event_id"))).distinct().collect()]
    return read_or_empty(spark, index, SCHEMA).filter(F.col("bucket").isin(touched))

"""Which Bronze files hold which batch.

A batch id is inside the JSON text, so finding one batch would mean parsing every file.
The index is brought up to date from files it has not seen (by path, size and time), which
are parsed for their batch ids once; afterwards one batch opens its own files only.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emberlog.sources import bronze
from emberlog.sources.files import inventory, read_or_empty, write_table

BUCKETS = 64
SCHEMA = T.StructType([
    T.StructField("batch_id", T.StringType()),
    T.StructField("path", T.StringType()),
    T.StructField("length", T.LongType()),
    T.StructField("modificationTime", T.TimestampType()),
    T.StructField("bucket", T.IntegerType()),
])
_FILE = ["path", "length", "modificationTime"]


def index_path(bronze_folder: str) -> str:
    return f"{bronze_folder.rstrip('/')}_batches"


def _bucket(batch_id):
    return F.pmod(F.xxhash64(batch_id), F.lit(BUCKETS)).cast("int")


def new_files(spark: SparkSession, folder: str, index: str) -> DataFrame:
    """Files of the folder that the index has not seen as they are now."""
    listed = inventory(spark, folder, "*.{json,txt}").select(*_FILE)
    return listed.join(read_or_empty(spark, index, SCHEMA).select(*_FILE), _FILE, "left_anti")


def index_batches(spark: SparkSession, folder: str, index: str | None = None, layout: str = "lines") -> int:
    """Index the files not seen yet; returns how many those were.

    Their paths go through the driver, as do all paths of any file scan.
    """
    index = index or index_path(folder)
    fresh = new_files(spark, folder, index).collect()
    if not fresh:
        return 0
    files = spark.createDataFrame(fresh, T.StructType([SCHEMA[c] for c in _FILE]))
    documents = bronze.read_documents(spark, [f.path for f in fresh], layout)
    batches = bronze.unpacked(documents).select("path", "batch_id").distinct()
    # A file without any batch is kept with none, lest it be parsed again.
    rows = files.join(batches, "path", "left").withColumn("bucket", _bucket(F.coalesce("batch_id", F.lit(""))))
    write_table(rows.select(*SCHEMA.names), index, ("bucket",), "append", sort=["batch_id"])
    return len(fresh)


def files_of_batch(spark: SparkSession, index: str, batch_id: str) -> list[str]:
    """Paths of the files that hold a batch; reads one bucket of the index."""
    rows = read_or_empty(spark, index, SCHEMA).filter(
        (F.col("bucket") == _bucket(F.lit(batch_id))) & (F.col("batch_id") == batch_id)
    )
    return sorted(r.path for r in rows.select("path").distinct().collect())

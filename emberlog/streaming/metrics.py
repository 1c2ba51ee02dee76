"""Ingest metrics of running streams."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from emberlog.functions.numbers import whole_millis_between
from emberlog.sources.files import write_table

COLUMNS = (
    "name string, batch_id bigint, started string, rows bigint, rows_per_second double, "
    "duration_ms bigint"
)


def ingest_counters() -> list[Column]:
    """Observed while a micro-batch is written: events, verdicts, time span, arrival delay."""
    delay = whole_millis_between(F.col("timestamp"), F.col("ingestion_timestamp"))
    return [
        F.count(F.lit(1)).alias("events"),
        F.count_if("accepted").alias("accepted"),
        F.count_if(~F.col("accepted")).alias("refused"),
        F.min("timestamp").alias("first_event"),
        F.max("timestamp").alias("last_event"),
        F.count(delay).alias("delayed_events"),
        F.sum(delay).alias("delay_ms"),
    ]


COUNTERS = (
    "events bigint, accepted bigint, refused bigint, first_event timestamp, last_event timestamp, "
    "delayed_events bigint, delay_ms bigint, load string"
)


def write_counters(spark: SparkSession, folder: str, load: str, counters: dict) -> int:
    """One row for a micro-batch, in a folder of its load: handled again, it replaces its own."""
    row = tuple(counters[c.split()[0]] for c in COUNTERS.split(", ")[:-1]) + (load,)
    return write_table(spark.createDataFrame([row], COUNTERS), folder, ("load",))


def read_counters(spark: SparkSession, folder: str) -> DataFrame:
    """Counters of every micro-batch, with the mean delay between event and arrival."""
    rows = spark.read.schema(COUNTERS).parquet(folder)
    return rows.withColumn("mean_delay_ms", F.try_divide("delay_ms", "delayed_events"))


def _entry(progress) -> tuple:
    return (
        progress.name,
        int(progress.batchId),
        progress.timestamp,
        int(progress.numInputRows),
        float(progress.processedRowsPerSecond or 0.0),
        int(progress.batchDuration),
    )


def progress_table(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """Recent micro-batches of a query (Spark keeps a bounded number) as a table."""
    return spark.createDataFrame([_entry(p) for p in query.recentProgress], COLUMNS)


class MetricsListener(StreamingQueryListener):
    """Appends one JSON record per micro-batch with rows to a metrics folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def onQueryStarted(self, event):
        pass

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass

    def onQueryProgress(self, event):
        if event.progress.numInputRows:
            row = self.spark.createDataFrame([_entry(event.progress)], COLUMNS)
            row.coalesce(1).write.mode("append").json(self.path)

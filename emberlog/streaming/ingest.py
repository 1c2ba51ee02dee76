"""Arriving batches to Bronze, and Bronze to Silver, as streams."""

import json

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from emberlog import constants as C
from emberlog.functions.paths import batch_id_of
from emberlog.operators import contract, refine
from emberlog.plans.medallion import DOCUMENT, admitted, marked_rows, silver_input
from emberlog.schemas import SILVER_PARTITIONS, SILVER_SCHEMA
from emberlog.session import scratch_path
from emberlog.sources import bronze, id_index
from emberlog.sources.files import delete, void_files, write_table
from emberlog.sources.silver import read_silver_or_empty, touched_only
from emberlog.streaming import metrics
from emberlog.streaming.delivery import deliver

# A single document is read by one task.
MAX_FILE_BYTES = 1 << 30


def refused_events(
    checked: DataFrame, mode: str = "batch", max_events: int = C.MAX_EVENTS_PER_BATCH
) -> DataFrame:
    """Every event that is not accepted, with its text, place, own faults and its batch's.

    ``reasons`` lists all rules the event breaks; ``batch_reasons`` says why its document
    was refused as a whole (batch mode), also for events without a fault of their own.
    """
    faults = F.array_join(
        F.transform(contract.ERRORS, lambda e: F.concat(e["rule"], F.lit(":"), e["column"])), ","
    )
    rows = checked.filter(~F.col("accepted")).select(
        "path", DOCUMENT, "batch_id", "idx", "event_id", faults.alias("reasons"),
        F.col(bronze.EVENT_TEXT).alias("event"),
    )
    if mode != "batch":
        return rows.withColumn("batch_reasons", F.lit(None).cast("string")).drop(DOCUMENT)
    verdicts = contract.batch_verdict(checked, DOCUMENT, max_events).select(
        DOCUMENT, F.col("reasons").alias("batch_reasons")
    )
    return rows.join(verdicts, DOCUMENT, "left").drop(DOCUMENT)


def unusable_documents(rows: DataFrame) -> DataFrame:
    """Documents that are no batch at all, with their text; from :func:`marked_rows`."""
    return rows.filter(F.col("idx").isNull() & F.col(bronze.UNUSABLE).isNotNull()).select(
        "path", "batch_id", F.col(bronze.UNUSABLE).alias("reasons"),
        F.col(bronze.EVENT_TEXT).alias("event"),
    )


def unusable_files(files: DataFrame, max_bytes: int) -> DataFrame:
    """Files refused by their size alone, before anything is read."""
    return files.filter(F.col("length") > max_bytes).select(
        "path", batch_id_of(F.col("path")).alias("batch_id"), F.lit("too_large").alias("reasons")
    )


def note_void_files(spark: SparkSession, landing: str, rejects: str, load: str) -> int:
    """Write the files without a byte to the rejects; the same load again replaces its list."""
    found = [(path,) for path in void_files(spark, landing)]
    if not found:
        return 0
    nothing = F.lit(None).cast("string")
    rows = spark.createDataFrame(found, "path string").select(
        "path", batch_id_of(F.col("path")).alias("batch_id"), F.lit(None).cast("bigint").alias("idx"),
        nothing.alias("event_id"), F.lit("empty").alias("reasons"), nothing.alias("event"),
        nothing.alias("batch_reasons"), F.lit(load).alias("load"),
    )
    return write_table(rows, rejects, ("load",))


def ingest_batch(
    documents: DataFrame, load: str, target: str, rejects: str,
    mode: str = "batch", as_of: str | None = None, check_ids: bool = True,
    max_events: int = C.MAX_EVENTS_PER_BATCH, attempts: int = 3,
    files: DataFrame | None = None, max_bytes: int = MAX_FILE_BYTES, counters: str | None = None,
) -> None:
    """One micro-batch: check, append what is accepted, append what is not with reasons.

    ``files`` is the micro-batch's listing, by which files beyond ``max_bytes`` are refused.  ``counters``: folder for the micro-batch's counters, which fill while
    the accepted events are written.

    ``batch`` mode judges each document as a whole.  A file is never divided between
    micro-batches, so the verdict does not depend on how files arrive.

    Both writes go to folders named after ``load``, so repeating a micro-batch replaces
    its own output instead of adding to it.
    """
    # Parsed and marked once; verdicts, accepted events, refused ones and documents that are
    # no batch all come from these rows.
    rows = marked_rows(documents, as_of, check_ids).persist(StorageLevel.MEMORY_AND_DISK)
    checked = admitted(rows, mode, max_events)
    try:
        seen = Observation()
        accepted = checked.observe(seen, *metrics.ingest_counters()).filter("accepted")
        # The arrival time of the file, not the clock, so a retry lands in the same folder.
        packed = bronze.envelopes(accepted, max_events=max_events, stamp=F.col("modified"))
        deliver(lambda: bronze.write_envelopes(packed, target, load=load), attempts)

        refused = refused_events(checked, mode, max_events)
        refused = refused.unionByName(unusable_documents(rows), allowMissingColumns=True)
        if files is not None:
            refused = refused.unionByName(unusable_files(files, max_bytes), allowMissingColumns=True)
        keyed = refused.withColumn("load", F.lit(load))
        deliver(lambda: write_table(keyed, rejects, ("load",)), attempts)
        if counters is not None:
            deliver(lambda: metrics.write_counters(documents.sparkSession, counters, load, seen.get), attempts)
    finally:
        rows.unpersist()


def ingest_stream(
    spark: SparkSession, landing: str, target: str, rejects: str, checkpoint: str,
    layout: str = "document", max_files: int | None = None, name: str = "ingest",
    continuous: str | None = None, **options,
) -> StreamingQuery:
    """Stream of batch files from a landing folder into Bronze.

    Handles what is there and stops; ``continuous`` (a processing interval) keeps going.
    The stream is of file names and sizes, so that size is judged before any text is read;
    the files of one micro-batch (``max_files`` at most) are then read by name.  Files
    without a byte are in no listing of Spark's and are noted when the stream starts.
    """
    note_void_files(spark, landing, rejects, f"{name}-void")
    files = bronze.stream_files(spark, landing, max_files)
    max_bytes = options.pop("max_bytes", MAX_FILE_BYTES)

    def handle(batch: DataFrame, epoch: int) -> None:
        listed = batch.collect()
        good = [f.path for f in listed if f.length <= max_bytes]
        documents = bronze.read_documents(spark, good, layout)
        ingest_batch(
            documents, f"{name}-{epoch:08d}", target, rejects,
            files=spark.createDataFrame(listed, batch.schema), max_bytes=max_bytes, **options,
        )

    return _started(files.writeStream.foreachBatch(handle), checkpoint, name, continuous)


def _started(writer, checkpoint: str, name: str, continuous: str | None) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint).queryName(name)
    if continuous:
        return writer.trigger(processingTime=continuous).start()
    return writer.trigger(availableNow=True).start()


def refine_batch(
    documents: DataFrame, silver: str, as_of: str | None = None, rejects: str | None = None,
    load: str = "0", index: str | None = None,
) -> int:
    """One micro-batch to Silver, adding only ids that Silver does not hold yet.

    A repeat of an event is found however late it arrives and whatever raid or date it
    names: ids are looked up in the index beside Silver, in the buckets of this
    micro-batch's ids.  The ids are added before the rows; a micro-batch that is handled
    again (the same ``load``) therefore knows its own ids, and looks for its rows in the
    Silver partitions it touches.  Events without a readable time or raid have no
    partition: with ``rejects`` they go there under ``load``, else to Silver's null
    partition.
    """
    spark = documents.sparkSession
    index = index or id_index.index_path(silver)
    id_index.build_index(spark, silver, index)
    # A table, not the cache: most steps below read its ids alone, and its tasks follow its size.
    table = scratch_path(spark, "micro-batch")
    refine.as_silver(refine.refine(silver_input(documents, as_of))).write.parquet(table)
    refined = spark.read.schema(SILVER_SCHEMA).parquet(table)
    try:
        if rejects is not None:
            lost = F.col("event_date").isNull() | F.col("raid_id").isNull()
            write_table(refined.filter(lost).withColumn("load", F.lit(load)), rejects, ("load",))
            refined = refined.filter(~lost)
        held = id_index.held_ids(spark, index, refined)
        fresh = refine.not_yet_in(refined, held.filter(F.col("load") != load))
        own = held.filter(F.col("load") == load)
        if not own.isEmpty():
            fresh = refine.not_yet_in(fresh, touched_only(read_silver_or_empty(spark, silver), refined))
        id_index.add_ids(fresh, index, load)
        return write_table(fresh, silver, SILVER_PARTITIONS, "append", sort=["timestamp"])
    finally:
        delete(spark, table)


def refine_stream(
    spark: SparkSession, source: str, silver: str, checkpoint: str, layout: str = "lines",
    max_files: int | None = None, name: str = "refine", continuous: str | None = None,
    as_of: str | None = None, rejects: str | None = None,
) -> StreamingQuery:
    """Stream of Bronze files into Silver, each event once."""
    documents = bronze.stream_documents(spark, source, layout, max_files)

    def handle(batch: DataFrame, epoch: int) -> None:
        # Loads of another checkpoint count from zero again, so its identity is part of the name.
        run = spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first().value
        load = f"{name}-{json.loads(run)['id']}-{epoch:08d}"
        refine_batch(batch, silver, as_of, rejects, load)

    return _started(documents.writeStream.foreachBatch(handle), checkpoint, name, continuous)


def refine_stream_within(
    spark: SparkSession, source: str, silver: str, checkpoint: str, delay: str,
    layout: str = "lines", max_files: int | None = None, name: str = "refine-within",
    continuous: str | None = None, as_of: str | None = None,
) -> StreamingQuery:
    """The same with watermarked state instead of looking into Silver.

    Cheaper per micro-batch, but only as exact as ``delay``: an event older than the
    watermark is left out and counted in the query's dropped rows.  Use
    :func:`refine_stream` where every row has to arrive.
    """
    documents = bronze.stream_documents(spark, source, layout, max_files)
    typed = silver_input(documents, as_of).withWatermark("timestamp", delay)
    unique = typed.dropDuplicatesWithinWatermark(["event_id"])
    refined = refine.as_silver(refine.enrich(refine.in_range(unique)))
    writer = (
        refined.writeStream.format("parquet").option("path", silver)
        .partitionBy(*SILVER_PARTITIONS).outputMode("append")
    )
    return _started(writer, checkpoint, name, continuous)

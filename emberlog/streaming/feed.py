"""Live feed of accepted events and ordered replay of stored batches."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from emberlog.functions.paths import chunk_number, raid_of
from emberlog.operators.ordered import with_running
from emberlog.operators.refine import live_feed
from emberlog.plans.medallion import typed_events
from emberlog.session import materialise, scratch_path
from emberlog.sources.bronze import read_documents, stream_documents, unpacked
from emberlog.sources.files import read_or_empty, write_table


def feed(
    spark: SparkSession, source: str, layout: str = "lines", max_files: int | None = None
) -> DataFrame:
    """Stream of (raid, type, amount) for every event in Bronze.

    Bronze holds accepted batches only, so consumers see nothing that was not persisted.
    """
    return live_feed(typed_events(stream_documents(spark, source, layout, max_files)))


def subscribe(
    stream: DataFrame, consume: Callable[[DataFrame, int], None], checkpoint: str, name: str,
    continuous: str | None = None,
) -> StreamingQuery:
    """One independent query per consumer, each with its own checkpoint and position."""
    writer = stream.writeStream.foreachBatch(consume).queryName(name).option(
        "checkpointLocation", checkpoint
    )
    if continuous:
        return writer.trigger(processingTime=continuous).start()
    return writer.trigger(availableNow=True).start()


def stored_chunks(spark: SparkSession, path: str) -> DataFrame:
    """Stored chunks with their number, raid and event texts."""
    return unpacked(read_documents(spark, path, "lines")).select(
        "path", "event_count", "batch_id", chunk_number(F.col("batch_id")).alias("chunk"),
        F.coalesce(raid_of(F.col("path")), F.lit("unknown")).alias("raid_id"), "items",
    )


def _ordered(chunks: DataFrame, order: list[str], max_batches: int | None) -> DataFrame:
    if max_batches is not None:
        chunks = chunks.orderBy("raid_id", *order).limit(max_batches)
    return with_running(chunks, ["raid_id"], [F.col(c) for c in order], number="position")


def replay_plan(spark: SparkSession, path: str, max_batches: int | None = None) -> DataFrame:
    """Stored chunks in the order of their number per raid, with their position; bounded if asked."""
    return _ordered(stored_chunks(spark, path).drop("items"), ["chunk", "batch_id"], max_batches)


def replay_steps(
    spark: SparkSession, path: str, max_batches: int | None = None, step: int = 1000
) -> tuple[DataFrame, int]:
    """Stored chunks with position and step, laid in one folder per step; and the number of steps.

    The documents are parsed once, into a table.  Positions are worked out on its narrow
    columns, and the chunks are written again in the order in which they will be read.
    """
    chunks = materialise(
        stored_chunks(spark, path).withColumn("document", F.monotonically_increasing_id()), "chunks"
    )
    places = materialise(
        _ordered(chunks.drop("items"), ["chunk", "batch_id", "document"], max_batches)
        .withColumn("step", F.floor((F.col("position") - 1) / step).cast("int")),
        "places",
    )
    due = places.join(chunks.select("document", "items"), "document").drop("document")
    folder = scratch_path(spark, "steps")
    write_table(due, folder, ("step",), sort=["raid_id", "position"])
    steps = places.agg(F.coalesce(F.max("step") + 1, F.lit(0))).first()[0]
    return read_or_empty(spark, folder, due.schema), steps


def replay_batches(
    spark: SparkSession, path: str, send: Callable[[DataFrame], None],
    max_batches: int | None = None, step: int = 1000, steps_a_call: int = 1,
) -> int:
    """Hand stored chunks over in order, ``step`` positions of every raid at a time.

    ``send`` gets the documents of a step with their position, read from that step's folder
    alone; it is called for the next step only after it returned.  A consumer that keeps
    rows in order by ``step`` and ``position`` itself may take several consecutive steps in
    one call, and so in one Spark job.  Returns the number of chunks handed over.
    """
    chunks, steps = replay_steps(spark, path, max_batches, step)
    for first in range(0, steps, steps_a_call):
        send(chunks.filter(F.col("step").between(first, first + steps_a_call - 1)))
    return chunks.count()

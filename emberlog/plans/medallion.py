"""Bronze to Silver to Gold."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlog import constants as C
from emberlog.operators import contract, quality, refine
from emberlog.plans.gold import gold_tables, publish, read_tables
from emberlog.schemas import EVENT_COLUMNS
from emberlog.session import materialise
from emberlog.sources import batch_index, bronze
from emberlog.sources.files import write_table
from emberlog.sources.silver import read_silver, read_silver_or_empty, touched_only, write_silver


DOCUMENT = "_document"


@dataclass(frozen=True)
class Layers:
    """Folders of the layers."""

    bronze: str
    silver: str
    gold: str
    rejects: str


def typed_events(documents: DataFrame, as_of: str | None = None) -> DataFrame:
    """Parsed, typed and defaulted events of raw documents."""
    return refine.fill_defaults(refine.parse_text_events(bronze.events_of(documents)), as_of)


def silver_input(documents: DataFrame, as_of: str | None = None) -> DataFrame:
    """What refinement needs: the contract columns and the place in the batch.

    Leaving out the checks' columns saves their parsing and keeps them out of the shuffle.
    """
    typed = refine.fill_defaults(refine.parse_text_events(bronze.plain_events(documents)), as_of)
    return typed.select(*EVENT_COLUMNS, "batch_id", "idx")


def batch_documents(
    spark: SparkSession, layers: Layers, batch_id: str, layout: str = "lines"
) -> DataFrame:
    """The documents of the files that hold a batch, found by the index beside Bronze."""
    index = batch_index.index_path(layers.bronze)
    batch_index.index_batches(spark, layers.bronze, index, layout)
    return bronze.read_documents(spark, batch_index.files_of_batch(spark, index, batch_id), layout)


def refusal() -> Column:
    """Why a refined event is no Silver row; null for those that are."""
    return (
        F.when(F.col("event_date").isNull(), "no_readable_time")
        .when(F.col("raid_id").isNull(), "no_raid")
        .when(refine.out_of_range(), "health_out_of_range")
    )


def run_silver(
    spark: SparkSession, layers: Layers, layout: str = "lines", batch_id: str | None = None,
    incremental: bool = False, as_of: str | None = None,
) -> dict:
    """Bronze to Silver for everything, or for one batch, whose files alone are opened.

    ``incremental`` (always on for one batch) adds only ids that the touched Silver
    partitions lack; otherwise the partitions present in Bronze are replaced.

    One pass parses, types and de-duplicates the documents and marks every event; what has
    no readable time, no raid or an impossible health goes to ``silver`` below the rejects
    folder with its reason.  Rows in are Silver rows, rejects, repeats and rows held before.
    """
    if batch_id is None:
        events = silver_input(bronze.read_documents(spark, layers.bronze, layout), as_of)
    else:
        events = silver_input(batch_documents(spark, layers, batch_id, layout), as_of)
        events, incremental = events.filter(F.col("batch_id") == batch_id), True
    distinct, seen, unique = refine.distinct_observed(events)
    marked = materialise(refine.enrich(distinct).withColumn("reason", refusal()), "refined")
    refined = marked.filter("reason IS NULL")
    if incremental:
        held = touched_only(read_silver_or_empty(spark, layers.silver), refined)
        refined = refine.not_yet_in(refined, held)
    load = "all" if batch_id is None else batch_id
    refused = marked.filter("reason IS NOT NULL").withColumn("load", F.lit(load))
    rejected = write_table(refused, f"{layers.rejects.rstrip('/')}/silver", ("load",))
    result = write_silver(refined.drop("reason"), layers.silver, "append" if incremental else "overwrite")
    return {"stage": "silver", **result, **refine.refine_metrics(seen, unique), "rejected": rejected}


def run_gold_stage(
    spark: SparkSession, layers: Layers, policy: str = "reject", **options
) -> list[dict]:
    tables = gold_tables(read_silver(spark, layers.silver), **options)
    written = publish(tables, layers.gold, policy)
    write_table(quality.coherence(*read_tables(spark, layers.gold)), f"{layers.gold}/coherence")
    return [{"stage": "gold", **entry} for entry in written]


def run_medallion(
    spark: SparkSession, layers: Layers, layout: str = "lines", policy: str = "reject",
    as_of: str | None = None, **options,
) -> DataFrame:
    """The whole chain; returns one row per table written."""
    steps = [run_silver(spark, layers, layout, as_of=as_of)]
    steps += run_gold_stage(spark, layers, policy, **options)
    rows = [
        (s["stage"], s.get("table", "events"), s["path"], s["rows"], s.get("status", "success"))
        for s in steps
    ]
    return spark.createDataFrame(
        rows, "stage string, table string, path string, rows bigint, status string"
    )


def marked_rows(
    documents: DataFrame, as_of: str | None = None, check_ids: bool = True
) -> DataFrame:
    """Events of raw documents with ``errors`` from the full contract and their ``_document``,
    besides a row without a position for each document that is no batch."""
    rows = refine.fill_defaults(refine.parse_text_events(bronze.event_rows(documents)), as_of)
    typed = rows.withColumn(DOCUMENT, F.concat_ws("#", "path", "batch_id"))
    return contract.mark(typed, contract.event_rules(as_of, check_ids, from_text=True))


def checked_events(
    documents: DataFrame, as_of: str | None = None, mode: str = "batch",
    max_events: int = C.MAX_EVENTS_PER_BATCH, check_ids: bool = True,
) -> DataFrame:
    """Events of raw documents with ``errors`` and ``accepted`` from the full contract.

    In ``batch`` mode a document is accepted or refused as a whole (``_document``: its path
    and batch id).
    """
    return admitted(marked_rows(documents, as_of, check_ids), mode, max_events)


def admitted(
    rows: DataFrame, mode: str = "batch", max_events: int = C.MAX_EVENTS_PER_BATCH
) -> DataFrame:
    """The events of :func:`marked_rows` with ``accepted``."""
    events = rows.filter(F.col("idx").isNotNull()).drop(bronze.UNUSABLE)
    return contract.admit(events, mode, DOCUMENT, max_events)

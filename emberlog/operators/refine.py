"""Bronze events to Silver: typing, defaults, de-duplication, ranges, enrichment."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emberlog import constants as C
from emberlog.functions import coercion
from emberlog.functions.numbers import whole_millis_between
from emberlog.functions.paths import derived_id
from emberlog.operators.contract import UNCAST
from emberlog.schemas import EVENT_SCHEMA, SILVER_SCHEMA

HEALTH_COLUMNS = ("target_entity_health_pct_before", "target_entity_health_pct_after")
_FLAG_COLUMNS = ("is_critical_hit", "is_resisted", "is_blocked", "is_absorbed")


def cast_types(events: DataFrame) -> DataFrame:
    """Contract types for every event column present; what does not parse becomes null."""
    have = {f.name: f.dataType for f in events.schema.fields}
    return events.withColumns({
        f.name: F.expr(coercion.typed_sql(f.name, have[f.name], f.dataType))
        for f in EVENT_SCHEMA.fields
        if f.name in have
    })


def parse_text_events(raw: DataFrame) -> DataFrame:
    """Typed events from all-text ones, trimmed, with ``_uncast``: columns that failed."""
    text = [
        f.name for f in raw.schema.fields
        if f.name in EVENT_SCHEMA.names and isinstance(f.dataType, T.StringType)
    ]
    failed = []
    for name in text:
        want = EVENT_SCHEMA[name].dataType
        if isinstance(want, T.ArrayType):
            # A list field must hold a JSON list when it holds anything.
            failed.append(f"if({name} IS NOT NULL AND NOT startswith({name}, '['), '{name}', NULL)")
        elif not isinstance(want, T.StringType):
            typed = coercion.typed_sql(name, T.StringType(), want)
            failed.append(f"if({name} IS NOT NULL AND {typed} IS NULL, '{name}', NULL)")
    names = f"filter(array({', '.join(failed)}), x -> x IS NOT NULL)"
    trimmed = raw.withColumns({
        name: F.btrim(F.col(name), F.lit(C.WHITE_SPACE)) for name in text
    })
    return cast_types(trimmed.withColumn(UNCAST, F.expr(names)))


def fill_defaults(events: DataFrame, as_of: str | None = None) -> DataFrame:
    """Contract defaults; a missing event id becomes a repeatable hash of the row."""
    arrived = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    values: dict[str, Column] = {
        name: F.coalesce(F.col(name), F.lit(False)) for name in _FLAG_COLUMNS
    }
    values["critical_multiplier"] = F.coalesce("critical_multiplier", F.lit(1.0))
    values["source_system"] = F.coalesce("source_system", F.lit(C.DEFAULT_SOURCE_SYSTEM))
    values["data_quality_flags"] = coercion.clean_tags(F.col("data_quality_flags"))
    values["ingestion_timestamp"] = F.coalesce(F.col("ingestion_timestamp"), arrived)
    identity = [
        F.col(c) for c in ("batch_id", "idx", "raid_id", "timestamp", "event_type",
                           "source_player_id", "target_entity_id", "damage_amount",
                           "healing_amount")
        if c in events.columns
    ]
    values["event_id"] = F.coalesce(F.col("event_id"), derived_id(*identity))
    return events.withColumns({k: v for k, v in values.items() if k in events.columns})


def deduplicate(
    events: DataFrame,
    keys: Sequence[str] = ("event_id",),
    order: Sequence[str] = ("ingestion_timestamp", "batch_id", "idx"),
    copies: str | None = None,
) -> DataFrame:
    """Keep the earliest delivery of each event.

    ``copies`` names a column for the number of deliveries, counted in the same aggregation.

    Taking the smallest row is an aggregation, so each task first reduces its own copies:
    an id delivered a billion times shuffles one row per task, where a ranking window
    would gather all copies in one place.  All columns take part in the comparison, so
    the result does not depend on input order even between equal deliveries.
    """
    ranked = [c for c in order if c in events.columns and c not in keys]
    rest = [c for c in events.columns if c not in keys and c not in ranked]
    smallest = F.min(F.struct(*ranked, *rest)).alias("_kept")
    columns = [F.col(c) if c in keys else F.col(f"_kept.{c}").alias(c) for c in events.columns]
    if copies is None:
        return events.groupBy(*keys).agg(smallest).select(*columns)
    counted = events.groupBy(*keys).agg(smallest, F.count(F.lit(1)).alias(copies))
    return counted.select(*columns, copies)


def _out_of_range(name: str) -> Column:
    value = F.col(name)
    return F.coalesce((value < 0) | (value > 100), F.lit(False))


def out_of_range(columns: Sequence[str] = HEALTH_COLUMNS) -> Column:
    """Whether any health percentage lies outside 0..100."""
    broken = F.lit(False)
    for name in columns:
        broken = broken | _out_of_range(name)
    return broken


def in_range(events: DataFrame, columns: Sequence[str] = HEALTH_COLUMNS) -> DataFrame:
    """Drop rows with a health percentage outside 0..100; null stays."""
    for name in columns:
        events = events.filter(~_out_of_range(name))
    return events


def in_bounds(
    events: DataFrame, bounds: Sequence[tuple[str, float | None, float | None]]
) -> DataFrame:
    """Drop rows outside any of the (column, low, high) bounds; null stays."""
    for name, low, high in bounds:
        value, broken = F.col(name), F.lit(False)
        if low is not None:
            broken = broken | (value < low)
        if high is not None:
            broken = broken | (value > high)
        events = events.filter(~F.coalesce(broken, F.lit(False)))
    return events


def range_errors(columns: Sequence[str] = HEALTH_COLUMNS) -> list[Column]:
    """Counts per column; a row already out by an earlier column is not counted again."""
    counts, clean = [], F.lit(True)
    for name in columns:
        counts.append(F.count_if(clean & _out_of_range(name)).alias(f"bad_{name}"))
        clean = clean & ~_out_of_range(name)
    return counts


def enrich(events: DataFrame, massive_hit: float = C.MASSIVE_HIT_DAMAGE) -> DataFrame:
    """Ingest latency, massive-hit flag and UTC event date."""
    have = set(events.columns)
    latency = massive = None
    if {"ingestion_timestamp", "timestamp"} <= have:
        latency = F.coalesce(
            whole_millis_between(
                F.col("timestamp").cast("timestamp"), F.col("ingestion_timestamp").cast("timestamp")
            ),
            F.lit(0).cast("bigint"),
        )
    if {"damage_amount", "event_type"} <= have:
        massive = F.coalesce(
            (F.col("event_type") == "combat_damage") & (F.col("damage_amount") > massive_hit),
            F.lit(False),
        )
    added = {"is_massive_hit": massive if massive is not None else F.lit(False)}
    if latency is not None:
        added["ingest_latency_ms"] = latency
    if "timestamp" in have:
        added["event_date"] = F.to_date("timestamp")
    return events.withColumns(added)


def refine(events: DataFrame, massive_hit: float = C.MASSIVE_HIT_DAMAGE) -> DataFrame:
    """Typing, de-duplication, range filter and enrichment in one plan.

    One shuffle, on the event id.
    """
    return enrich(in_range(deduplicate(cast_types(events))), massive_hit)


def refine_observed(
    events: DataFrame, massive_hit: float = C.MASSIVE_HIT_DAMAGE
) -> tuple[DataFrame, Observation, Observation]:
    """:func:`refine` with counters that fill while the result is written.

    The first observation has ``rows_in``; the second ``rows_unique`` and the range errors.
    """
    distinct, seen, unique = distinct_observed(events)
    return enrich(in_range(distinct), massive_hit), seen, unique


def distinct_observed(events: DataFrame) -> tuple[DataFrame, Observation, Observation]:
    """Typed events, each once, before any is left out; with the same counters."""
    seen, unique = Observation(), Observation()
    typed = cast_types(events).observe(seen, F.count(F.lit(1)).alias("rows_in"))
    distinct = deduplicate(typed).observe(
        unique, F.count(F.lit(1)).alias("rows_unique"), *range_errors()
    )
    return distinct, seen, unique


def refine_metrics(seen: Observation, unique: Observation) -> dict[str, int]:
    """Counters of a finished :func:`refine_observed` run."""
    counts = unique.get
    bad = {k: v for k, v in counts.items() if k.startswith("bad_")}
    return {
        "rows_in": seen.get["rows_in"],
        "duplicates_removed": seen.get["rows_in"] - counts["rows_unique"],
        **bad,
        "rows_after_validation": counts["rows_unique"] - sum(bad.values()),
    }


def refine_report(events: DataFrame) -> DataFrame:
    """The same counters as one row, for use as a query; one scan of the events."""
    per_id = deduplicate(cast_types(events), copies="_copies").agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("rows_in"),
        F.count(F.lit(1)).alias("rows_unique"), *range_errors(),
    )
    bad = [F.col(f"bad_{c}") for c in HEALTH_COLUMNS]
    return per_id.select(
        "rows_in",
        (F.col("rows_in") - F.col("rows_unique")).alias("duplicates_removed"),
        *bad,
        (F.col("rows_unique") - bad[0] - bad[1]).alias("rows_after_validation"),
    )


def as_silver(events: DataFrame) -> DataFrame:
    """Exactly the Silver columns, in order and type; absent ones become null."""
    have = set(events.columns)
    return events.selectExpr(*[
        f"CAST({f.name if f.name in have else 'NULL'} AS {f.dataType.simpleString()}) AS {f.name}"
        for f in SILVER_SCHEMA.fields
    ])


def not_yet_in(events: DataFrame, silver: DataFrame) -> DataFrame:
    """Events whose id the Silver table does not hold, for loads across batches."""
    return events.join(silver.select("event_id"), "event_id", "left_anti")


def legacy_names(frame: DataFrame) -> DataFrame:
    """Rename to the squashed legacy column names."""
    return frame.withColumnsRenamed(
        {new: old for new, old in C.LEGACY_NAMES.items() if new in frame.columns}
    )


def live_feed(events: DataFrame) -> DataFrame:
    """Raid, type, and the damage or healing amount (zero counts as absent)."""
    amount = F.coalesce(
        F.when(F.col("damage_amount") != 0, F.col("damage_amount")),
        F.when(F.col("healing_amount") != 0, F.col("healing_amount")),
    )
    return events.select("raid_id", "event_type", amount.alias("amount"))

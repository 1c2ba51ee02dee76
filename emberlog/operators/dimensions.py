"""Participant and raid dimensions."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlog import constants as C
from emberlog.functions.coercion import unknown_if_null
from emberlog.operators.facts import first_label, is_player, player_totals

_LABELS = ("player_name", "player_class", "player_role")


def dim_player_from(totals: DataFrame, player_prefix: str | None = C.PLAYER_ID_PREFIX) -> DataFrame:
    """Participants from the (raid, source) roll-up, where a raid is already one row."""
    players = totals.filter(
        F.col("source_player_id").isNotNull() & is_player(F.col("source_player_id"), player_prefix)
    )
    grouped = players.groupBy(F.col("source_player_id").alias("player_id")).agg(
        *[first_label(label).alias(label) for label in _LABELS],
        F.min("first_date").alias("first_seen_date"),
        F.max("last_date").alias("last_seen_date"),
        F.count("raid_id").alias("total_raids"),
    )
    return grouped.select(
        "player_id",
        "player_name",
        unknown_if_null(F.col("player_class")).alias("player_class"),
        unknown_if_null(F.col("player_role")).alias("player_role"),
        "first_seen_date",
        "last_seen_date",
        "total_raids",
    )


def dim_player(events: DataFrame, player_prefix: str | None = C.PLAYER_ID_PREFIX) -> DataFrame:
    """One row per participant: labels, raids taken part in, first and last date."""
    return dim_player_from(player_totals(events), player_prefix)


def dim_raid_from(
    summary: DataFrame,
    boss_name: str = C.DEFAULT_BOSS_NAME,
    difficulty: str = C.DEFAULT_DIFFICULTY,
    target_ms: float = C.DEFAULT_TARGET_DURATION_MS,
) -> DataFrame:
    """One row per raid of a summary (or lean fact joined to its date)."""
    return summary.select(
        "raid_id",
        "event_date",
        F.lit(boss_name).alias("boss_name"),
        F.lit(difficulty).alias("difficulty"),
        F.col("n_players").alias("raid_size"),
        F.lit(target_ms).cast("double").alias("duration_target_ms"),
    )


def dim_raid(
    events: DataFrame, player_prefix: str | None = None, **placeholders
) -> DataFrame:
    """Raid dimension straight from events: size, date and the placeholder columns.

    Without a prefix every source counts toward the size, bosses included.
    """
    totals = player_totals(events)
    counted = totals.filter(is_player(F.col("source_player_id"), player_prefix))
    sizes = counted.groupBy("raid_id").agg(
        F.count("source_player_id").alias("n_players"), F.min("first_date").alias("event_date")
    )
    return dim_raid_from(sizes, **placeholders)


def with_event_dates(facts: DataFrame, events: DataFrame) -> DataFrame:
    """Add each raid's first event date to a fact table that lacks it."""
    dates = events.groupBy("raid_id").agg(
        F.min(F.col("event_date").cast("date")).alias("event_date")
    )
    return facts.join(dates, "raid_id", "left")


def stamped(frame: DataFrame, as_of: str | None = None) -> DataFrame:
    """Add ``ingested_at``: the load time, or a fixed one for repeatable runs."""
    moment = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    return frame.withColumn("ingested_at", moment)

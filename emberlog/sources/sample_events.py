"""Encounter events derived from a generic ``events`` stream table.

The stream has ``event_id, ts, user_id, event_type, value, props``; every row becomes
one encounter event.  All expressions are row-local, so the scan stays one narrow stage.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlog.constants import PLAYER_CLASSES
from emberlog.functions.paths import padded
from emberlog.schemas import EVENT_SCHEMA

PLAYERS = 25
EVENTS_PER_BATCH = 500


def read_stream_table(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/events.parquet")


def as_encounter_events(stream: DataFrame, per_batch: int = EVENTS_PER_BATCH) -> DataFrame:
    """One encounter event per stream row, plus its ``event_date``, ``batch_id`` and ``idx``."""
    # Stripping ``{"k": 7}`` to its number; cheap, because pushed-down filters repeat it.
    stream = stream.withColumn("_k", F.translate("props", '{"k": }', "").cast("int"))
    k = F.col("_k")
    kind = F.col("event_type")
    slot = F.col("user_id") % PLAYERS
    day = F.dayofmonth("ts")
    boss = F.concat(F.lit("boss_"), day.cast("string"))

    def player(number):
        return F.concat(F.lit("player_"), padded(number, 3))

    is_error = kind == "error"
    is_death = is_error & (k < 50)
    event_type = (
        F.when(kind == "purchase", "combat_damage")
        .when(kind == "click", "heal")
        .when(kind == "view", "spell_cast")
        .when(kind == "signup", "mana_regeneration")
        .when(is_death, "player_death")
        .otherwise("boss_phase")
    )
    on_boss = kind.isin("purchase", "view") | (is_error & ~is_death)
    values = {
        "event_id": F.concat(F.lit("ev_"), F.col("event_id").cast("string")),
        "event_type": event_type,
        "timestamp": F.col("ts"),
        "raid_id": F.concat(F.lit("raid"), padded(day, 3)),
        "source_player_id": F.when(is_error, boss).otherwise(player(slot)),
        "source_player_name": F.when(is_error, "Boss").otherwise(
            F.concat(F.lit("P"), padded(slot, 3))
        ),
        "source_player_role": F.when(is_error, F.lit(None))
        .when(slot % 10 == 0, "tank")
        .when((slot % 10).isin(1, 2), "healer")
        .otherwise("dps"),
        "source_player_class": F.when(
            ~is_error,
            F.element_at(
                F.array(*[F.lit(name) for name in PLAYER_CLASSES]),
                (slot % len(PLAYER_CLASSES) + 1).cast("int"),
            ),
        ),
        "damage_amount": F.when(kind == "purchase", F.col("value") * 300),
        "healing_amount": F.when(kind == "click", F.col("value") * 190),
        "is_critical_hit": kind.isin("purchase", "click") & (k % 6 == 0),
        "target_entity_type": F.when(on_boss, "boss").otherwise("player"),
        "target_entity_id": F.when(on_boss, boss).otherwise(
            player((F.col("user_id") + k) % PLAYERS)
        ),
        "target_entity_health_pct_before": F.when(
            kind.isin("purchase", "click", "error"), (k * F.lit(1.1) - 4)
        ),
        "target_entity_health_pct_after": F.when(
            kind.isin("purchase", "click") | (is_error & ~is_death), k.cast("double")
        ).when(is_death, F.lit(0.0)),
        "ingestion_timestamp": F.timestamp_add("MILLISECOND", k * 37, F.col("ts")),
        "server_latency_ms": (k % 60 + 20).cast("bigint"),
        "resource_type": F.when(kind == "signup", "mana"),
    }
    columns = [
        values[field.name].alias(field.name)
        if field.name in values
        else F.lit(None).cast(field.dataType).alias(field.name)
        for field in EVENT_SCHEMA.fields
    ]
    batch = F.floor(F.col("event_id") / per_batch).cast("bigint")
    return stream.select(
        *columns,
        F.to_date("ts").alias("event_date"),
        F.concat(F.lit("b"), padded(batch, 9)).alias("batch_id"),
        (F.col("event_id") % per_batch).alias("idx"),
    )


def with_redelivery(events: DataFrame) -> DataFrame:
    """Every event delivered twice, the second time one hour later in another batch."""
    again = events.withColumns({
        "ingestion_timestamp": F.timestamp_add("HOUR", F.lit(1), F.col("ingestion_timestamp")),
        "batch_id": F.concat(F.lit("again_"), F.col("batch_id")),
    })
    return events.unionByName(again)


def encounter_events(
    spark: SparkSession, folder: str, per_batch: int = EVENTS_PER_BATCH
) -> DataFrame:
    return as_encounter_events(read_stream_table(spark, folder), per_batch)

"""Table schemas.  Readers always pass one of these; nothing is inferred."""

from pyspark.sql import types as T

_STRING, _DOUBLE, _LONG, _BOOL = T.StringType(), T.DoubleType(), T.LongType(), T.BooleanType()
_TIME, _DATE, _TAGS = T.TimestampType(), T.DateType(), T.ArrayType(T.StringType())


def _struct(columns: dict[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in columns.items()])


EVENT_SCHEMA = _struct(
    {
        "event_id": _STRING,
        "event_type": _STRING,
        "timestamp": _TIME,
        "raid_id": _STRING,
        "encounter_id": _STRING,
        "encounter_duration_ms": _LONG,
        "source_player_id": _STRING,
        "source_player_name": _STRING,
        "source_player_role": _STRING,
        "source_player_class": _STRING,
        "source_player_level": _LONG,
        "ability_id": _STRING,
        "ability_name": _STRING,
        "ability_school": _STRING,
        "damage_amount": _DOUBLE,
        "healing_amount": _DOUBLE,
        "is_critical_hit": _BOOL,
        "critical_multiplier": _DOUBLE,
        "is_resisted": _BOOL,
        "is_blocked": _BOOL,
        "is_absorbed": _BOOL,
        "target_entity_id": _STRING,
        "target_entity_name": _STRING,
        "target_entity_type": _STRING,
        "target_entity_health_pct_before": _DOUBLE,
        "target_entity_health_pct_after": _DOUBLE,
        "resource_type": _STRING,
        "resource_amount_before": _DOUBLE,
        "resource_amount_after": _DOUBLE,
        "resource_regeneration_rate": _DOUBLE,
        "ingestion_timestamp": _TIME,
        "source_system": _STRING,
        "data_quality_flags": _TAGS,
        "server_latency_ms": _LONG,
        "client_latency_ms": _LONG,
    }
)
EVENT_COLUMNS = tuple(EVENT_SCHEMA.fieldNames())

# Every event field as the text found in the JSON document.
RAW_EVENT_SCHEMA = _struct({name: _STRING for name in EVENT_COLUMNS})

SILVER_SCHEMA = T.StructType(
    EVENT_SCHEMA.fields
    + _struct({"is_massive_hit": _BOOL, "ingest_latency_ms": _LONG, "event_date": _DATE}).fields
)
SILVER_PARTITIONS = ("raid_id", "event_date")

RAID_SUMMARY_SCHEMA = _struct(
    {
        "raid_id": _STRING,
        "event_date": _DATE,
        "duration_ms": _DOUBLE,
        "total_damage": _DOUBLE,
        "total_healing": _DOUBLE,
        "total_player_deaths": _LONG,
        "n_players": _LONG,
        "n_tanks": _LONG,
        "n_healers": _LONG,
        "n_dps": _LONG,
        "raid_dps": _DOUBLE,
        "raid_hps": _DOUBLE,
        "boss_min_hp_pct": _DOUBLE,
        "raid_outcome": _STRING,
    }
)
PLAYER_STATS_SCHEMA = _struct(
    {
        "raid_id": _STRING,
        "event_date": _DATE,
        "player_id": _STRING,
        "player_name": _STRING,
        "player_class": _STRING,
        "player_role": _STRING,
        "damage_total": _DOUBLE,
        "healing_total": _DOUBLE,
        "damage_events": _LONG,
        "healing_events": _LONG,
        "player_deaths": _LONG,
        "crit_events": _LONG,
        "crit_rate": _DOUBLE,
        "total_damage_received": _DOUBLE,
        "dps": _DOUBLE,
        "hps": _DOUBLE,
        "damage_share": _DOUBLE,
        "healing_share": _DOUBLE,
    }
)
DIM_PLAYER_SCHEMA = _struct(
    {
        "player_id": _STRING,
        "player_name": _STRING,
        "player_class": _STRING,
        "player_role": _STRING,
        "first_seen_date": _DATE,
        "last_seen_date": _DATE,
        "total_raids": _LONG,
    }
)
DIM_RAID_SCHEMA = _struct(
    {
        "raid_id": _STRING,
        "event_date": _DATE,
        "boss_name": _STRING,
        "difficulty": _STRING,
        "raid_size": _LONG,
        "duration_target_ms": _DOUBLE,
    }
)
# Who took part in which raid, kept beside the facts.
BRIDGE = "bridge_player_raid"
IMPACT_SCHEMA = _struct(
    {
        "raid_id": _STRING,
        "event_date": _DATE,
        "player_id": _STRING,
        "player_name": _STRING,
        "impact_score": _DOUBLE,
        "impact_rank": _LONG,
        "impact_band": _STRING,
        "style_cluster": _STRING,
    }
)
BRIDGE_SCHEMA = _struct({"player_id": _STRING, "raid_id": _STRING, "event_date": _DATE})
GOLD_SCHEMAS = {
    BRIDGE: BRIDGE_SCHEMA,
    "fact_raid_summary": RAID_SUMMARY_SCHEMA,
    "fact_player_raid_stats": PLAYER_STATS_SCHEMA,
    "dim_player": DIM_PLAYER_SCHEMA,
    "dim_raid": DIM_RAID_SCHEMA,
    "player_impact_index": IMPACT_SCHEMA,
}
GOLD_PARTITIONS = {
    BRIDGE: ("raid_id", "event_date"),
    "fact_raid_summary": ("raid_id", "event_date"),
    "fact_player_raid_stats": ("raid_id", "event_date"),
    "dim_player": (),
    "dim_raid": (),
    "player_impact_index": ("raid_id", "event_date"),
}

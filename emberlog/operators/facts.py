"""Facts per raid and per participant.

Both facts come from one roll-up.  The first aggregation keys on everything a participant
carries (raid, id, name, class, role) and keeps only fixed-width values, so it runs as a
hash aggregation with a map-side combine and a raid holding most of the events reaches
the shuffle as a handful of rows.  Later levels work on that small table: distinct
participants and roles become plain sums, first values become the earliest variant.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlog import constants as C
from emberlog.functions.numbers import mean, millis_between, ratio, seconds, total

PLAYER_KEY = ("raid_id", "source_player_id")
_VARIANT = PLAYER_KEY + ("source_player_name", "source_player_class", "source_player_role")
_LABELS = {
    "source_player_name": "player_name",
    "source_player_class": "player_class",
    "source_player_role": "player_role",
}


def is_player(source_id: Column, prefix: str | None) -> Column:
    """True for participants; with no prefix every source counts as one."""
    return F.lit(True) if prefix is None else F.coalesce(source_id.startswith(prefix), F.lit(False))


def only_players(events: DataFrame, prefix: str = C.PLAYER_ID_PREFIX) -> DataFrame:
    """Keep events whose source is a participant; reaches the scan as a prefix filter."""
    return events.filter(F.col("source_player_id").startswith(prefix))


def _of_type(*types: str) -> Column:
    return F.col("event_type").isin(*types)


def first_label(name: str) -> Column:
    """Earliest non-null variant of a label; equal times resolve to the smaller text."""
    value = F.col(name)
    return F.min_by(
        F.when(value.isNotNull(), value),
        F.when(value.isNotNull(), F.struct(F.col("first_ts"), value)),
    )


def player_variants(events: DataFrame, sum_type: str = "double") -> DataFrame:
    """Level one: one row per raid, source and label combination."""
    damage, heal, death = _of_type("combat_damage"), _of_type("heal"), _of_type("player_death")
    boss_hp = F.when(
        F.col("target_entity_type") == "boss", F.col("target_entity_health_pct_after")
    )
    kept = events.filter(F.col("raid_id").isNotNull())
    return kept.groupBy(*_VARIANT).agg(
        F.min("timestamp").alias("first_ts"),
        F.max("timestamp").alias("last_ts"),
        F.min(F.col("event_date").cast("date")).alias("first_date"),
        F.max(F.col("event_date").cast("date")).alias("last_date"),
        F.sum(F.when(damage, F.col("damage_amount")).cast(sum_type)).alias("damage"),
        F.sum(F.when(heal, F.col("healing_amount")).cast(sum_type)).alias("healing"),
        F.count_if(damage).alias("damage_events"),
        F.count_if(heal).alias("healing_events"),
        F.count_if(death).alias("deaths"),
        F.count_if((damage | heal) & F.coalesce("is_critical_hit", F.lit(False))).alias("crits"),
        F.min(boss_hp).alias("boss_hp"),
    )


def player_totals(events: DataFrame, sum_type: str = "double") -> DataFrame:
    """Level two: one row per raid and source, with labels and role flags.

    Persist this when several facts are built from it; it is small next to the events.
    """
    def has_role(role: str) -> Column:
        return F.max(F.when(F.col("source_player_role") == role, 1).otherwise(0))

    return player_variants(events, sum_type).groupBy(*PLAYER_KEY).agg(
        *[first_label(source).alias(label) for source, label in _LABELS.items()],
        *[has_role(role).cast("bigint").alias(f"as_{role}") for role in C.PLAYER_ROLES],
        F.min("first_ts").alias("first_ts"),
        F.max("last_ts").alias("last_ts"),
        F.min("first_date").alias("first_date"),
        F.max("last_date").alias("last_date"),
        F.sum("damage").alias("damage"),
        F.sum("healing").alias("healing"),
        F.sum("damage_events").alias("damage_events"),
        F.sum("healing_events").alias("healing_events"),
        F.sum("deaths").alias("deaths"),
        F.sum("crits").alias("crits"),
        F.min("boss_hp").alias("boss_hp"),
    )


def raid_outcome(
    boss_hp: Column,
    duration_ms: Column,
    deaths: Column,
    players: Column,
    max_duration_ms: float = C.OUTCOME_MAX_DURATION_MS,
    near_kill_pct: float = C.OUTCOME_NEAR_KILL_PCT,
) -> Column:
    """``success`` for a kill in time, or a near kill with no more deaths than players."""
    killed = (boss_hp == 0) & (duration_ms <= max_duration_ms)
    near_kill = (boss_hp < near_kill_pct) & (deaths <= players)
    return F.when(killed | near_kill, "success").otherwise("wipe")


def apply_outcome(summary: DataFrame, **limits: float) -> DataFrame:
    """(Re)judge every raid of a summary table."""
    return summary.withColumn(
        "raid_outcome",
        raid_outcome(
            F.col("boss_min_hp_pct"), F.col("duration_ms"),
            F.col("total_player_deaths"), F.col("n_players"), **limits,
        ),
    )


def summarise_raids(totals: DataFrame, player_prefix: str | None = None, **limits: float) -> DataFrame:
    """Raid facts from :func:`player_totals`.

    With a prefix, only participants shape the measures; deaths still count every source,
    because a death event may carry the boss as its source.  Raids without participants
    are left out.
    """
    player = is_player(F.col("source_player_id"), player_prefix) & F.col(
        "source_player_id"
    ).isNotNull()
    # Without a prefix an event with no source still belongs to its raid.
    counts = F.lit(True) if player_prefix is None else player

    def over(name: str) -> Column:
        return F.when(counts, F.col(name))

    duration = millis_between(F.col("first_ts"), F.col("last_ts"))
    base = totals.groupBy("raid_id").agg(
        F.count_if(counts).alias("sources"),
        F.min(over("first_ts")).alias("first_ts"),
        F.max(over("last_ts")).alias("last_ts"),
        F.min(over("first_date")).alias("event_date"),
        total(over("damage"), _decimal_or_double(totals, "damage")).alias("total_damage"),
        total(over("healing"), _decimal_or_double(totals, "healing")).alias("total_healing"),
        F.sum("deaths").alias("total_player_deaths"),
        F.count_if(player).alias("n_players"),
        *[
            F.coalesce(F.sum(F.when(player, F.col(f"as_{role}"))), F.lit(0)).alias(f"as_{role}")
            for role in C.PLAYER_ROLES
        ],
        F.coalesce(F.min(over("boss_hp")), F.lit(C.DEFAULT_BOSS_HP_PCT)).alias("boss_min_hp_pct"),
    )
    measured = base.filter(F.col("sources") > 0).select(
        "raid_id",
        "event_date",
        duration.alias("duration_ms"),
        "total_damage",
        "total_healing",
        "total_player_deaths",
        "n_players",
        F.col("as_tank").alias("n_tanks"),
        F.col("as_healer").alias("n_healers"),
        F.col("as_dps").alias("n_dps"),
        ratio(F.col("total_damage"), seconds(duration)).alias("raid_dps"),
        ratio(F.col("total_healing"), seconds(duration)).alias("raid_hps"),
        "boss_min_hp_pct",
    )
    return apply_outcome(measured, **limits)


def _decimal_or_double(frame: DataFrame, name: str) -> str:
    return frame.schema[name].dataType.simpleString()


def raid_summary(
    events: DataFrame, player_prefix: str | None = None, sum_type: str = "double", **limits: float
) -> DataFrame:
    """One row per raid: duration, volumes, composition, rates, boss health, outcome."""
    return summarise_raids(player_totals(events, sum_type), player_prefix, **limits)


def role_composition(totals: DataFrame, player_prefix: str | None = None) -> DataFrame:
    """Distinct participants per role, one column per role."""
    return summarise_raids(totals, player_prefix).select(
        "raid_id", "n_players", "n_tanks", "n_healers", "n_dps"
    )


def received_by_target(
    events: DataFrame, player_prefix: str | None = None, sum_type: str = "double"
) -> DataFrame:
    """Damage taken and deaths suffered per raid and target.

    Damage counts when its source is a participant; deaths count whatever the source.
    """
    damage = _of_type("combat_damage") & is_player(F.col("source_player_id"), player_prefix)
    relevant = events.filter(
        _of_type("combat_damage", "player_death")
        & F.col("raid_id").isNotNull()
        & F.col("target_entity_id").isNotNull()
    )
    return relevant.groupBy("raid_id", F.col("target_entity_id").alias("player_id")).agg(
        total(F.when(damage, F.col("damage_amount")), sum_type).alias("total_damage_received"),
        F.count_if(_of_type("player_death")).alias("deaths_as_target"),
    )


def describe_players(
    totals: DataFrame,
    received: DataFrame,
    summary: DataFrame,
    player_prefix: str | None = None,
    victim: str = "source_player_id",
) -> DataFrame:
    """Participant facts from the roll-up, the per-target sums and the raid facts.

    The joins carry no hint: the adaptive planner broadcasts a side after measuring it
    and otherwise splits a skewed raid.
    """
    if victim not in ("source_player_id", "target_entity_id"):
        raise ValueError(f"victim must name the source or target id, not {victim!r}")
    deaths = (
        F.col("deaths")
        if victim == "source_player_id"
        else F.coalesce("deaths_as_target", F.lit(0))
    )
    raid = summary.select(
        "raid_id", "event_date", "duration_ms",
        F.col("total_damage").alias("raid_damage"), F.col("total_healing").alias("raid_healing"),
    )
    acted = F.col("damage_events") + F.col("healing_events")
    duration_s = seconds(F.col("duration_ms"))
    return (
        totals.filter(
            F.col("source_player_id").isNotNull()
            & is_player(F.col("source_player_id"), player_prefix)
        )
        .withColumnRenamed("source_player_id", "player_id")
        .withColumn("damage_total", F.coalesce(F.col("damage").cast("double"), F.lit(0.0)))
        .withColumn("healing_total", F.coalesce(F.col("healing").cast("double"), F.lit(0.0)))
        .join(received, ["raid_id", "player_id"], "left")
        .join(raid, "raid_id", "left")
        .select(
            "raid_id",
            "event_date",
            "player_id",
            "player_name",
            "player_class",
            "player_role",
            "damage_total",
            "healing_total",
            "damage_events",
            "healing_events",
            deaths.alias("player_deaths"),
            F.col("crits").alias("crit_events"),
            ratio(F.col("crits"), acted).alias("crit_rate"),
            F.coalesce("total_damage_received", F.lit(0.0)).alias("total_damage_received"),
            ratio(F.col("damage_total"), duration_s).alias("dps"),
            ratio(F.col("healing_total"), duration_s).alias("hps"),
            F.when(
                F.col("raid_damage") > 0, ratio(F.col("damage_total"), F.col("raid_damage"))
            ).otherwise(0.0).alias("damage_share"),
            F.when(
                F.col("raid_healing") > 0, ratio(F.col("healing_total"), F.col("raid_healing"))
            ).otherwise(0.0).alias("healing_share"),
        )
    )


def player_raid_stats(
    events: DataFrame,
    summary: DataFrame | None = None,
    player_prefix: str | None = None,
    victim: str = "source_player_id",
    sum_type: str = "double",
) -> DataFrame:
    """One row per raid and participant: volumes, deaths, crits, rates, shares."""
    totals = player_totals(events, sum_type)
    if summary is None:
        summary = summarise_raids(totals, player_prefix)
    received = received_by_target(events, player_prefix, sum_type)
    return describe_players(totals, received, summary, player_prefix, victim)


def label_unknown(frame: DataFrame, columns=("player_class", "player_role")) -> DataFrame:
    """Null labels become ``unknown``."""
    return frame.fillna("unknown", subset=list(columns))


def count_unlabelled(frame: DataFrame, columns=("player_class", "player_role")) -> DataFrame:
    """How many rows miss each label."""
    return frame.agg(*[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns])


# --- the lean variants -----------------------------------------------------------------


def _lean_variants(events: DataFrame, sum_type: str) -> DataFrame:
    return events.groupBy(*_VARIANT).agg(
        F.min("timestamp").alias("first_ts"),
        F.max("timestamp").alias("last_ts"),
        F.count("event_id").alias("events"),
        F.sum(F.col("damage_amount").cast(sum_type)).alias("damage"),
        F.count("damage_amount").alias("damage_rows"),
        F.sum(F.col("healing_amount").cast(sum_type)).alias("healing"),
        F.sum(F.col("is_critical_hit").cast("int")).alias("crits"),
        F.sum("server_latency_ms").alias("latency"),
        F.count("server_latency_ms").alias("latency_rows"),
    )


def lean_raid_fact(events: DataFrame, sum_type: str = "double") -> DataFrame:
    """Event-level raid facts over every source, rounded to two digits."""
    per_source = _lean_variants(events, sum_type).groupBy(*PLAYER_KEY).agg(
        F.min("first_ts").alias("first_ts"),
        F.max("last_ts").alias("last_ts"),
        *[F.sum(c).alias(c) for c in (
            "events", "damage", "damage_rows", "healing", "crits", "latency", "latency_rows")],
    )
    duration_s = seconds(millis_between(F.min("first_ts"), F.max("last_ts")))

    def average(value: str, rows: str) -> Column:
        return F.try_divide(F.sum(value).cast("double"), F.sum(rows).cast("double"))

    return per_source.groupBy("raid_id").agg(
        F.sum("events").alias("total_events"),
        F.count("source_player_id").alias("n_players"),
        F.round(F.sum("damage").cast("double"), 2).alias("total_damage"),
        F.round(F.sum("healing").cast("double"), 2).alias("total_healing"),
        F.round(average("damage", "damage_rows"), 2).alias("avg_damage_per_event"),
        F.sum("crits").alias("n_critical_hits"),
        F.round(duration_s, 2).alias("raid_duration_s"),
        F.round(average("latency", "latency_rows"), 2).alias("avg_server_latency_ms"),
    )


def lean_player_fact(
    events: DataFrame, player_prefix: str = C.PLAYER_ID_PREFIX, sum_type: str = "double"
) -> DataFrame:
    """Event-level participant facts; the crit rate is in percent of all events."""
    merged = _lean_variants(only_players(events, player_prefix), sum_type).groupBy(*PLAYER_KEY).agg(
        *[first_label(source).alias(label) for source, label in _LABELS.items()],
        *[F.sum(c).alias(c) for c in ("events", "damage", "damage_rows", "healing", "crits")],
    )
    return merged.select(
        "source_player_id",
        "raid_id",
        "player_name",
        "player_class",
        "player_role",
        F.col("events").alias("total_events"),
        F.round(F.col("damage").cast("double"), 2).alias("total_damage"),
        F.round(F.col("healing").cast("double"), 2).alias("total_healing"),
        F.round(
            F.try_divide(F.col("damage").cast("double"), F.col("damage_rows").cast("double")), 2
        ).alias("avg_damage"),
        F.col("crits").alias("n_critical_hits"),
        F.round(
            F.try_divide(F.col("crits").cast("double") * 100, F.col("events").cast("double")), 2
        ).alias("critical_hit_rate_pct"),
    )


def player_averages(stats: DataFrame, sum_type: str = "double") -> DataFrame:
    """Mean rates and raid count per participant across raids."""
    return stats.groupBy("player_id", "player_name", "player_class", "player_role").agg(
        mean(F.col("dps"), sum_type).alias("avg_dps"),
        mean(F.col("hps"), sum_type).alias("avg_hps"),
        F.count("dps").alias("raids"),
    )

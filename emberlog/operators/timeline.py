"""Chunks, elapsed time, boss health and phases along a raid."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlog import constants as C
from emberlog.functions.numbers import whole_millis_between
from emberlog.session import materialise, small_side
from emberlog.operators.ordered import with_previous, with_running

_MONEY = "decimal(20,6)"


def chunked(
    events: DataFrame,
    size: int,
    group: Sequence[str] = ("raid_id",),
    order: Sequence[str] = ("timestamp", "event_id"),
) -> DataFrame:
    """Number consecutive runs of at most ``size`` events per group, from 1."""
    numbered = with_running(events, group, [F.col(c) for c in order])
    return numbered.withColumn("chunk", F.floor((F.col("seq") - 1) / size).cast("bigint") + 1)


def elapsed(events: DataFrame, group: str = "raid_id") -> DataFrame:
    """Milliseconds since the first event of the encounter.

    The start comes from an aggregation with a map-side combine and is joined back: sent to
    all tasks where it was counted to be small, so that events stay in place, and joined
    with a shuffle otherwise.
    """
    starts = small_side(events.groupBy(group).agg(F.min("timestamp").alias("_start")), "starts")
    return (
        events.join(starts, group, "left")
        .withColumn("elapsed_ms", whole_millis_between(F.col("_start"), F.col("timestamp")))
        .drop("_start")
    )


def boss_timeline(
    events: DataFrame,
    max_hp: float | Column,
    thresholds: Sequence[float] = C.BOSS_PHASE_THRESHOLDS,
) -> DataFrame:
    """Boss health and phase after each damaging hit on a boss, per raid and boss.

    Health only falls, so "one phase step per hit, when at or under the next threshold"
    has a closed form: phase *k* starts at the first hit at or under threshold *k*, but at
    least one hit after phase *k-1* started.  The first hits come from one aggregation.
    """
    full = (max_hp if isinstance(max_hp, Column) else F.lit(max_hp)).cast(_MONEY)
    hits = events.filter(
        (F.col("event_type") == "combat_damage") & (F.col("damage_amount") > 0)
        & (F.col("target_entity_type") == "boss")
    ).select(
        "raid_id", "event_id", "timestamp", "target_entity_id", "damage_amount",
        full.alias("max_hp"),
    )
    run = with_running(
        hits, ["raid_id", "target_entity_id"], [F.col("timestamp"), F.col("event_id")],
        number="hit", sums={"dealt": ("damage_amount", _MONEY)},
    )

    def health(dealt: Column) -> Column:
        left = F.greatest(F.lit(0).cast("decimal(30,6)"), F.col("max_hp") - dealt)
        return F.try_divide(left.cast("double"), F.col("max_hp").cast("double")) * 100.0

    run = run.withColumn("hp_pct_before", health(F.col("dealt") - F.col("damage_amount").cast(_MONEY)))
    run = run.withColumn("hp_pct_after", health(F.col("dealt")))
    # Used twice below; reading it back is cheaper than sorting every hit again.
    run = materialise(run, "hits")

    reached = [
        F.min(F.when(F.col("hp_pct_after") <= limit, F.col("hit"))).alias(f"_at{i}")
        for i, limit in enumerate(thresholds)
    ]
    firsts = run.groupBy("raid_id", "target_entity_id").agg(F.count(F.lit(1)).alias("_hits"), *reached)
    steps: list[Column] = []
    for i in range(len(thresholds)):
        at = F.col(f"_at{i}")
        # A raid that never gets there has a null step, and so have all later phases.
        steps.append(at if not steps else F.when(at.isNotNull(), F.greatest(at, steps[-1] + 1)))
    firsts = firsts.select(
        "raid_id", F.col("target_entity_id").alias("_boss"),
        *[s.alias(f"_step{i}") for i, s in enumerate(steps)],
    )
    firsts = small_side(firsts, "phases")
    joined = run.join(firsts.withColumnRenamed("raid_id", "_raid"),
                      (F.col("raid_id") == F.col("_raid"))
                      & F.col("target_entity_id").eqNullSafe(F.col("_boss")), "left")
    phase = F.lit(1)
    starts = F.lit(False)
    for i in range(len(thresholds)):
        step = F.col(f"_step{i}")
        phase = phase + F.coalesce((F.col("hit") >= step).cast("int"), F.lit(0))
        starts = starts | F.coalesce(F.col("hit") == step, F.lit(False))
    return joined.select(
        "raid_id", "event_id", "timestamp", "target_entity_id", "hit", "damage_amount",
        "hp_pct_before", "hp_pct_after",
        phase.cast("bigint").alias("phase"),
        starts.alias("is_transition"),
    )


def boss_transitions(timeline: DataFrame) -> DataFrame:
    """One ``boss_phase`` event per phase change of a timeline."""
    return timeline.filter("is_transition").select(
        "raid_id",
        "timestamp",
        F.lit("boss_phase").alias("event_type"),
        F.col("target_entity_id").alias("source_player_id"),
        F.col("target_entity_id").alias("target_entity_id"),
        F.lit("boss").alias("target_entity_type"),
        F.col("hp_pct_before").alias("target_entity_health_pct_before"),
        F.col("hp_pct_after").alias("target_entity_health_pct_after"),
        "phase",
        F.concat(F.lit("boss_phase_"), F.col("phase").cast("string")).alias("flag"),
    )


def out_of_order(
    events: DataFrame, group: Sequence[str], sequence: Sequence[str]
) -> DataFrame:
    """Per group: events, repeated ids, and events older than the one delivered before."""
    ordered = with_previous(
        events.select(*dict.fromkeys([*group, *sequence, "event_id", "timestamp"])),
        group, [F.col(c) for c in sequence], "timestamp", "previous_ts",
    )
    # Distinct ids through two ordinary aggregations instead of an expanding one.
    per_id = ordered.groupBy(*group, "event_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("timestamp") < F.col("previous_ts")).alias("late"),
    )
    return per_id.groupBy(*group).agg(
        F.sum("n").alias("events"),
        F.sum(F.col("n") - 1).alias("repeated_ids"),
        F.sum("late").alias("out_of_order"),
    )

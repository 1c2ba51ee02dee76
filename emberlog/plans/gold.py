"""Silver to Gold in one job for all raids."""

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlog import constants as C
from emberlog.operators import contract, dimensions, facts, ranking
from emberlog.operators.profile import stack_tables
from emberlog.operators.upsert import upsert_dim_player, upsert_dim_raid
from emberlog.schemas import BRIDGE, BRIDGE_SCHEMA
from emberlog.session import materialise
from emberlog.sources.files import exists
from emberlog.sources.gold import read_gold, write_gold
from emberlog.sources.silver import read_silver, read_silver_partition


IMPACT = "player_impact_index"


class GoldTables(NamedTuple):
    fact_raid_summary: DataFrame
    fact_player_raid_stats: DataFrame
    dim_player: DataFrame
    dim_raid: DataFrame


def gold_from(
    totals: DataFrame, received: DataFrame, player_prefix: str | None, victim: str, **limits: float
) -> GoldTables:
    summary = facts.summarise_raids(totals, player_prefix, **limits)
    stats = facts.label_unknown(
        facts.describe_players(totals, received, summary, player_prefix, victim)
    )
    return GoldTables(
        summary,
        stats,
        dimensions.dim_player_from(totals, player_prefix),
        dimensions.dim_raid_from(summary),
    )


def gold_tables(
    events: DataFrame,
    player_prefix: str | None = C.PLAYER_ID_PREFIX,
    victim: str = "source_player_id",
    sum_type: str = "double",
    **limits: float,
) -> GoldTables:
    """The four tables.

    Events are scanned once for the roll-up and once, a few columns wide, for damage
    taken.  Both results are small next to the events and are written to the shared
    folder, so checking and writing four tables never goes back to the events, whatever
    happens to an executor.
    """
    totals = materialise(facts.player_totals(events, sum_type), "totals")
    received = materialise(facts.received_by_target(events, player_prefix, sum_type), "received")
    return gold_from(totals, received, player_prefix, victim, **limits)


def raid_status(tables: GoldTables) -> DataFrame:
    """``ok`` or ``failed`` per raid, with the broken rules.

    Failure of one raid is a row here, not an exception that stops the others.
    """
    broken = []
    for name in ("fact_raid_summary", "fact_player_raid_stats", "dim_raid"):
        marked = contract.mark(getattr(tables, name), contract.GOLD_RULES[name]())
        broken.append(
            marked.filter(contract.is_broken())
            .select("raid_id", F.explode("errors").alias("e"))
            .select(
                "raid_id",
                F.concat(F.lit(f"{name}."), F.col("e.column"), F.lit(":"), F.col("e.rule")).alias("reason"),
            )
        )
    # Rule names are a fixed vocabulary, so the collected set of a raid stays short.
    reasons = stack_tables(*broken).groupBy("raid_id").agg(
        F.array_join(F.sort_array(F.collect_set("reason")), ",").alias("reasons")
    )
    return tables.fact_raid_summary.select("raid_id").join(reasons, "raid_id", "left").select(
        "raid_id",
        F.when(F.col("reasons").isNull(), "ok").otherwise("failed").alias("status"),
        F.coalesce("reasons", F.lit("")).alias("reasons"),
    )


def publish(
    tables: GoldTables, folder: str, policy: str = "fail",
    fact_partitions: Sequence[str] | None = None, with_impact: bool = False,
) -> list[dict]:
    """Check every table, then write dimensions before facts.

    ``with_impact`` adds ``player_impact_index``, computed from the participant facts,
    checked by its own contract, and written below raid and date like them.

    Facts lie below raid and date unless ``fact_partitions`` says otherwise; with very
    many raids ``("event_date",)`` avoids one small file per raid.

    ``fail``: any broken row stops the publication before the first write.
    ``reject``: broken rows go to one ``rejects`` table, as JSON with the rules they
    break, and the others are published.
    """
    if policy not in ("fail", "reject"):
        raise ValueError(f"policy must be 'fail' or 'reject', not {policy!r}")
    order = ("dim_player", "dim_raid", "fact_raid_summary", "fact_player_raid_stats")
    frames = {name: getattr(tables, name) for name in order}
    if with_impact:
        # Written once, as it is checked and then published.
        order += (IMPACT,)
        frames[IMPACT] = materialise(ranking.impact_index(tables.fact_player_raid_stats), "impact")
    rejects = []
    if policy == "fail":
        contract.enforce_all(frames)
    else:
        for name, frame in frames.items():
            valid, bad = contract.split(contract.mark(frame, contract.GOLD_RULES[name]()))
            frames[name] = valid
            rejects.append(bad.select(
                F.lit(name).alias("table"), F.to_json(F.struct(*frame.columns)).alias("row"),
                contract.ERRORS,
            ))
    results = [
        write_gold(
            contract.conform(frames[name], name), folder, name,
            fact_partitions if name.startswith("fact_") or name == IMPACT else (),
        )
        for name in order
    ]
    # Who took part in which raid, replaced partition by partition like the facts.
    bridge = frames["fact_player_raid_stats"].select(*BRIDGE_SCHEMA.names)
    write_gold(bridge, folder, BRIDGE, fact_partitions)
    if rejects:
        results.append(write_gold(stack_tables(*rejects), folder, "rejects", ()))
    return results


def read_tables(spark: SparkSession, folder: str) -> GoldTables:
    """The published tables."""
    return GoldTables(*[read_gold(spark, folder, name) for name in GoldTables._fields])


def run_gold(
    spark: SparkSession, silver: str, folder: str, policy: str = "fail",
    fact_partitions: Sequence[str] | None = None, with_impact: bool = False, **options,
) -> list[dict]:
    """All raids of a Silver table in one job."""
    tables = gold_tables(read_silver(spark, silver), **options)
    return publish(tables, folder, policy, fact_partitions, with_impact)


def run_gold_partition(
    spark: SparkSession, silver: str, folder: str, raid_id: str, event_date: str,
    policy: str = "fail", fact_partitions: Sequence[str] | None = None, **options,
) -> list[dict]:
    """One raid and date; facts of other partitions stay as they are.

    Dimensions are merged into what is already published, and running the same partition
    again changes nothing.  Of the facts nothing is read: who took part in the raid before
    is in the raid's own part of the bridge.
    """
    # Facts of a partition that cannot be read whole would look complete.
    events = read_silver_partition(spark, silver, raid_id, event_date, strict=True)
    tables = gold_tables(events, **options)
    ensure_bridge(spark, folder, fact_partitions)
    before = read_gold(spark, folder, BRIDGE).filter(F.col("raid_id") == raid_id)
    others = before.filter(F.col("event_date") != F.lit(event_date).cast("date"))
    after = others.select("player_id").unionByName(tables.fact_player_raid_stats.select("player_id"))
    players = merge_players(
        read_gold(spark, folder, "dim_player"), tables.dim_player,
        before.select("player_id").distinct(), after.distinct(),
    )
    raids = upsert_dim_raid(read_gold(spark, folder, "dim_raid"), tables.dim_raid)
    # Materialised first: the merge reads the folders that the write replaces.
    merged = tables._replace(
        dim_player=materialise(players, "dim_player"), dim_raid=materialise(raids, "dim_raid")
    )
    return publish(merged, folder, policy, fact_partitions)


def ensure_bridge(
    spark: SparkSession, folder: str, fact_partitions: Sequence[str] | None = None
) -> None:
    """Write the bridge once for a layer that was published without one."""
    if not exists(spark, f"{folder.rstrip('/')}/{BRIDGE}"):
        stats = read_gold(spark, folder, "fact_player_raid_stats")
        write_gold(stats.select(*BRIDGE_SCHEMA.names), folder, BRIDGE, fact_partitions)


def merge_players(
    known: DataFrame, new: DataFrame, before: DataFrame, after: DataFrame
) -> DataFrame:
    """Participants after one raid was computed again.

    ``before`` and ``after`` hold the raid's participants.  Dates widen; raid counts change
    by one for those who joined the raid or are no longer in it.
    """
    change = (
        after.join(before, "player_id", "left_anti").withColumn("_change", F.lit(1).cast("bigint"))
        .unionByName(before.join(after, "player_id", "left_anti").withColumn("_change", F.lit(-1).cast("bigint")))
    )
    held = known.select(
        "player_id", F.col("total_raids").alias("_raids"), F.col("last_seen_date").alias("_last")
    )
    counted = (
        new.join(held, "player_id", "left").join(change, "player_id", "left")
        .withColumns({
            "total_raids": F.coalesce("_raids", F.lit(0)) + F.coalesce("_change", F.lit(0)),
            "last_seen_date": F.greatest("last_seen_date", "_last"),
        })
        .select(*new.columns)
    )
    left = known.join(change.filter("_change < 0"), "player_id").join(
        new.select("player_id"), "player_id", "left_anti"
    ).withColumn("total_raids", F.col("total_raids") - 1)
    return upsert_dim_player(known, counted.unionByName(left.select(*new.columns)), "min")

"""Counts, shares and distributions that describe a table."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlog import constants as C
from emberlog.functions.numbers import percent


def with_share(counts: DataFrame, value: str = "events", out: str = "pct") -> DataFrame:
    """Add each row's percentage of the column total.

    The total is a scalar subquery over the counts, which reuses their exchange; no
    window over the whole table is needed.
    """
    whole = counts.agg(F.sum(value).alias("_whole")).scalar()
    return counts.withColumn(out, percent(F.col(value), whole))


def count_by(events: DataFrame, *columns: str, out: str = "events") -> DataFrame:
    return events.groupBy(*columns).agg(F.count(F.lit(1)).alias(out))


def event_types(events: DataFrame) -> DataFrame:
    """Rows per event type with their share."""
    return with_share(count_by(events, "event_type"))


def labels(events: DataFrame, column: str) -> DataFrame:
    """Rows per role or class with their share of the labelled rows."""
    return with_share(count_by(events.filter(F.col(column).isNotNull()), column))


def top_classes(events: DataFrame, k: int = 10) -> DataFrame:
    return (
        labels(events, "source_player_class")
        .orderBy(F.col("events").desc(), "source_player_class")
        .limit(k)
    )


def raid_profile(events: DataFrame, file: str = "batch_id") -> DataFrame:
    """Per raid: events, files, counts by type, labelled rows, boss phases.

    Grouping by (raid, file) first makes the number of files a plain count.
    """
    per_file = events.groupBy("raid_id", file).agg(
        F.count(F.lit(1)).alias("events"),
        *[F.count_if(F.col("event_type") == t).alias(t) for t in C.EVENT_TYPES],
        F.count("source_player_class").alias("with_class"),
        F.count("source_player_role").alias("with_role"),
    )
    summed = ("events", *C.EVENT_TYPES, "with_class", "with_role")
    return per_file.groupBy("raid_id").agg(
        F.count(file).alias("files"), *[F.sum(c).alias(c) for c in summed]
    )


def raid_type_profile(events: DataFrame) -> DataFrame:
    """Rows per raid and type, with the share inside the raid."""
    counts = count_by(events, "raid_id", "event_type")
    whole = counts.groupBy("raid_id").agg(F.sum("events").alias("_whole"))
    return counts.join(whole, "raid_id").select(
        "raid_id", "event_type", "events",
        percent(F.col("events"), F.col("_whole")).alias("pct"),
    )


def amount_profile(events: DataFrame) -> DataFrame:
    """Mean, sample deviation and range of damage; mean and deviation of healing.

    Zero and null amounts take no part.
    """
    damage = F.when(
        (F.col("event_type") == "combat_damage") & (F.col("damage_amount") != 0),
        F.col("damage_amount"),
    )
    heal = F.when(
        (F.col("event_type") == "heal") & (F.col("healing_amount") != 0), F.col("healing_amount")
    )
    return events.agg(
        F.count(damage).alias("damage_rows"),
        F.avg(damage).alias("damage_mean"),
        F.stddev_samp(damage).alias("damage_stdev"),
        F.min(damage).alias("damage_min"),
        F.max(damage).alias("damage_max"),
        F.count(heal).alias("heal_rows"),
        F.avg(heal).alias("heal_mean"),
        F.stddev_samp(heal).alias("heal_stdev"),
    )


def distribution(dimension: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per value for several columns, stacked as (attribute, value, players)."""
    pairs = F.inline(
        F.array(*[
            F.struct(F.lit(c).alias("attribute"), F.col(c).alias("value")) for c in columns
        ])
    )
    return count_by(dimension.select(pairs), "attribute", "value", out="players")


def grand_totals(summary: DataFrame) -> DataFrame:
    return summary.agg(
        F.count(F.lit(1)).alias("raids"),
        F.sum("total_damage").alias("total_damage"),
        F.sum("total_healing").alias("total_healing"),
        F.sum("total_player_deaths").alias("total_deaths"),
        F.count_if(F.col("raid_outcome") == "success").alias("successes"),
    )


def massive_hit_rate(events: DataFrame) -> DataFrame:
    """Massive hits and their percentage of all events."""
    hits, rows = F.count_if("is_massive_hit"), F.count(F.lit(1))
    return events.agg(
        rows.alias("events"), hits.alias("massive_hits"), percent(hits, rows).alias("massive_pct")
    )


def batch_cardinality(events: DataFrame, batch: str = "batch_id") -> DataFrame:
    """Distinct raids, types and participants of each batch.

    Events are first counted per combination of the three values, with a map-side combine;
    only those few rows are then spread to one row per value.
    """
    names = ("raid_id", "event_type", "source_player_id")
    combined = events.groupBy(batch, *names).agg(F.count(F.lit(1)).alias("rows"))
    # The first of a combination's three rows carries its count, so that each event counts once.
    pairs = combined.select(batch, F.inline(F.array(*[
        F.struct(F.lit(c).alias("attribute"), F.col(c).alias("value"),
                 (F.col("rows") if i == 0 else F.lit(0).cast("bigint")).alias("rows"))
        for i, c in enumerate(names)
    ])))
    seen = pairs.groupBy(batch, "attribute", "value").agg(F.sum("rows").alias("rows"))

    def distinct(name: str):
        return F.count_if((F.col("attribute") == name) & F.col("value").isNotNull())

    return seen.groupBy(batch).agg(
        F.sum("rows").alias("events"),
        distinct("raid_id").alias("raids"),
        distinct("event_type").alias("event_types"),
        distinct("source_player_id").alias("players"),
    )


def values_seen(events: DataFrame, batch: str = "batch_id", column: str = "event_type") -> DataFrame:
    """Sorted text list of an enumerated column's values per batch."""
    return (
        count_by(events.filter(F.col(column).isNotNull()), batch, column)
        .groupBy(batch)
        .agg(F.array_join(F.sort_array(F.collect_set(column)), ",").alias("values"))
    )


def consolidated_raids(
    summary: DataFrame, dim_raid: DataFrame, stats: DataFrame, tolerance: float = C.SHARE_TOLERANCE
) -> DataFrame:
    """One line per raid: facts, dimension, size text and coherence flags."""
    shares = stats.groupBy("raid_id").agg(F.sum("damage_share").alias("_share"))
    sized = dim_raid.select("raid_id", "boss_name", "difficulty", "raid_size", "duration_target_ms")
    joined = summary.join(sized, "raid_id", "left").join(shares, "raid_id", "left")
    fk = F.col("raid_size").isNotNull()
    size_ok = F.coalesce(F.col("n_players") <= F.col("raid_size"), F.lit(False))
    share_ok = F.coalesce(F.abs(F.col("_share") - 1.0) < tolerance, F.lit(False))
    return joined.select(
        "raid_id",
        "event_date",
        "boss_name",
        "difficulty",
        "raid_outcome",
        "total_damage",
        "total_healing",
        "raid_dps",
        "raid_hps",
        "total_player_deaths",
        F.concat(
            F.col("n_players").cast("string"), F.lit("/"), F.col("raid_size").cast("string")
        ).alias("players"),
        "boss_min_hp_pct",
        fk.alias("fk_raid_ok"),
        size_ok.alias("raid_size_ok"),
        share_ok.alias("damage_share_ok"),
        (fk & size_ok & share_ok).alias("coherence_ok"),
    )


def sample_rows(frame: DataFrame, columns: Sequence[str], order: Sequence[str], n: int = 3) -> DataFrame:
    """First ``n`` rows in an explicit order."""
    return frame.select(*columns).orderBy(*order).limit(n)


def merge_counts(left: DataFrame, right: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Add up two count tables."""
    return left.unionByName(right).groupBy(*keys).agg(F.sum(value).alias(value))


def stack_tables(*frames: DataFrame) -> DataFrame:
    """Union by name; a column absent from one table is null there."""
    stacked = frames[0]
    for frame in frames[1:]:
        stacked = stacked.unionByName(frame, allowMissingColumns=True)
    return stacked


def partitions(frame: DataFrame) -> DataFrame:
    """Distinct (raid, date) pairs, sorted."""
    return frame.select("raid_id", "event_date").distinct().orderBy("raid_id", "event_date")



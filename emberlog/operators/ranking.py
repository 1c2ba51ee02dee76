"""Top-k lists and the impact index.

Ranks are limited inside each map task before the shuffle (``row_number() <= k``), and
global lists use take-ordered, so neither gathers a whole group.  Ties go to the smaller id.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from emberlog import constants as C
from emberlog.functions.numbers import clamp

LABELS = ("player_name", "player_class", "player_role")


def top_per_raid(
    stats: DataFrame, measure: str, k: int = 3, extra: tuple[str, ...] = (),
    where: Column | None = None,
) -> DataFrame:
    """The ``k`` highest participants of each raid by one measure."""
    chosen = stats if where is None else stats.filter(where)
    order = W.partitionBy("raid_id").orderBy(F.col(measure).desc(), "player_id")
    return (
        chosen.withColumn("place", F.row_number().over(order).cast("bigint"))
        .filter(F.col("place") <= k)
        .select("raid_id", "place", "player_id", *LABELS, measure, *extra)
    )


def top_overall(
    stats: DataFrame, measure: str, k: int = 3, extra: tuple[str, ...] = (),
    where: Column | None = None,
) -> DataFrame:
    """The ``k`` highest rows of the whole table by one measure."""
    chosen = stats if where is None else stats.filter(where)
    return chosen.select("player_id", *LABELS, measure, *extra).orderBy(
        F.col(measure).desc(), "player_id"
    ).limit(k)


def top_dps(stats: DataFrame, k: int = 3) -> DataFrame:
    return top_per_raid(stats, "dps", k, ("damage_share",))


def top_hps(stats: DataFrame, k: int = 3) -> DataFrame:
    return top_per_raid(stats, "hps", k, ("healing_share",), F.col("hps") > 0)


def most_deaths(stats: DataFrame, k: int = 3) -> DataFrame:
    return top_per_raid(stats, "player_deaths", k, (), F.col("player_deaths") > 0)


def top_crit(stats: DataFrame, k: int = 3) -> DataFrame:
    acted = F.col("damage_events") + F.col("healing_events") > 0
    return top_per_raid(stats, "crit_rate", k, (), acted)


def top_average(averages: DataFrame, measure: str, k: int = 5) -> DataFrame:
    """Best participants across raids; healing averages of zero do not take part."""
    where = F.col("avg_hps") > 0 if measure == "avg_hps" else None
    return top_overall(averages, measure, k, ("raids",), where)


def impact_score() -> Column:
    """Weighted share, crit and death score, held within 0..100."""
    score = F.lit(0.0)
    for name, weight in C.IMPACT_WEIGHTS.items():
        score = score + F.lit(weight) * (F.col(name) * F.lit(C.IMPACT_SCALES[name]))
    return clamp(score, 0.0, 100.0)


def impact_band(score: Column) -> Column:
    band = None
    for floor, name in C.IMPACT_BANDS:
        band = F.when(score >= floor, name) if band is None else band.when(score >= floor, name)
    return band.otherwise(C.IMPACT_LOWEST_BAND)


def impact_index(stats: DataFrame, digits: int | None = None) -> DataFrame:
    """Score, place in the raid, band and (still unknown) style of each participant.

    ``stats`` has one row per participant and raid, so a raid of any number of events is a
    short group here, and the numbering reads its sorted rows as a stream.
    """
    score = impact_score() if digits is None else F.round(impact_score(), digits)
    scored = stats.select(
        "raid_id", "event_date", "player_id", "player_name", score.alias("impact_score")
    )
    place = W.partitionBy("raid_id").orderBy(F.col("impact_score").desc(), "player_id")
    ranked = scored.withColumn("impact_rank", F.row_number().over(place).cast("bigint"))
    return ranked.select(
        "raid_id", "event_date", "player_id", "player_name", "impact_score", "impact_rank",
        impact_band(F.col("impact_score")).alias("impact_band"),
        F.lit("unknown").alias("style_cluster"),
    )

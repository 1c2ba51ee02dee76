"""Declarative row contracts.

A rule names what it checks and carries an SQL condition that is true when the row breaks
it; as text, a whole rule set reaches the engine as one expression.
``mark`` evaluates a rule set in one narrow projection and leaves an ``errors`` array on
each row; everything else (splitting, batch verdicts, reports) works from that array.
"""

from collections.abc import Iterable, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from emberlog import constants as C

ERRORS = "errors"
BROKEN = "_broken"
UNCAST = "_uncast"
EXTRA_KEYS = "_extra_keys"


class Rule(NamedTuple):
    """A check: its name, the column it is about, and the SQL condition that breaks it."""

    rule: str
    column: str
    broken: str


class ContractError(ValueError):
    """Tables break their contract; ``broken`` maps table to (rule, column) to row count."""

    def __init__(self, broken: dict[str, dict[tuple[str, str], int]]):
        self.broken = broken
        listed = "; ".join(
            f"{table}: "
            + ", ".join(f"{rule}({column}): {n}" for (rule, column), n in sorted(counts.items()))
            for table, counts in sorted(broken.items())
        )
        super().__init__(f"contract broken in {listed}")


# --- building blocks -------------------------------------------------------------------


def missing(column: str) -> Rule:
    return Rule("required", column, f"{column} IS NULL")


def _outside(value: str, low, high) -> str:
    sides = [f"{value} < {low}"] if low is not None else []
    if high is not None:
        sides.append(f"{value} > {high}")
    return " OR ".join(sides)


def outside(column: str, low, high) -> Rule:
    return Rule("range", column, _outside(column, low, high))


def wrong_length(column: str, shortest: int | None, longest: int | None) -> Rule:
    return Rule("length", column, _outside(f"length({column})", shortest, longest))


def not_one_of(column: str, allowed: Iterable[str], ignore_case: bool = False) -> Rule:
    value = f"lower({column})" if ignore_case else column
    listed = ", ".join(f"'{a}'" for a in allowed)
    return Rule("domain", column, f"{value} NOT IN ({listed})")


def not_matching(column: str, pattern: str) -> Rule:
    return Rule("pattern", column, f"NOT rlike({column}, r'{pattern}')")


def needs_positive(event_type: str, column: str) -> Rule:
    """Events of the type must carry a value above zero."""
    return Rule(
        "conditional", column,
        f"event_type = '{event_type}' AND ({column} IS NULL OR {column} <= 0)",
    )


# --- rule sets -------------------------------------------------------------------------


def event_rules(
    as_of: str | None = None, check_ids: bool = True, from_text: bool = False
) -> list[Rule]:
    """Contract of one event.

    ``as_of`` replaces the current time in the future check.  ``from_text`` adds the two
    rules that need the raw document: values that did not parse and unknown fields.
    """
    now = "current_timestamp()" if as_of is None else f"CAST('{as_of}' AS timestamp)"
    rules = [missing(c) for c in C.REQUIRED_EVENT_COLUMNS]
    if check_ids:
        rules.append(not_matching("event_id", C.UUID_PATTERN))
    rules += [
        not_one_of("event_type", C.EVENT_TYPES),
        not_one_of("source_player_role", C.PLAYER_ROLES),
        not_one_of("source_player_class", C.PLAYER_CLASSES),
        not_one_of("ability_school", C.ABILITY_SCHOOLS),
        not_one_of("target_entity_type", C.ENTITY_TYPES),
        not_one_of("resource_type", C.RESOURCE_TYPES),
        not_matching("raid_id", C.RAID_ID_PATTERN),
    ]
    rules += [wrong_length(*entry) for entry in C.EVENT_LENGTHS]
    rules += [outside(*entry) for entry in C.EVENT_BOUNDS]
    rules += [
        Rule("future", "timestamp", f"CAST(timestamp AS timestamp) > {now}"),
        needs_positive("combat_damage", "damage_amount"),
        needs_positive("heal", "healing_amount"),
        Rule(
            "conditional", "resource_type",
            "event_type = 'mana_regeneration' AND resource_type IS NULL",
        ),
    ]
    if from_text:
        rules += [
            Rule("type", UNCAST, f"size({UNCAST}) > 0"),
            Rule("extra", EXTRA_KEYS, f"size({EXTRA_KEYS}) > 0"),
        ]
    return rules


def dim_player_rules() -> list[Rule]:
    required = ("player_id", "player_name", "player_class", "player_role",
                "first_seen_date", "last_seen_date", "total_raids")
    return [missing(c) for c in required] + [
        wrong_length("player_id", 1, None),
        wrong_length("player_name", 1, 12),
        wrong_length("player_class", 1, None),
        not_one_of("player_role", C.GOLD_ROLES, ignore_case=True),
        outside("total_raids", 1, None),
    ]


def dim_raid_rules() -> list[Rule]:
    return [missing(c) for c in ("raid_id", "event_date", "raid_size", "duration_target_ms")] + [
        not_matching("raid_id", C.RAID_ID_PATTERN),
        outside("raid_size", 1, 40),
        not_one_of("difficulty", C.DIFFICULTIES),
        outside("duration_target_ms", 0, None),
    ]


def raid_summary_rules() -> list[Rule]:
    measures = ("duration_ms", "total_damage", "total_healing", "total_player_deaths",
                "n_tanks", "n_healers", "n_dps", "raid_dps", "raid_hps")
    required = ("raid_id", "event_date", *measures, "n_players", "boss_min_hp_pct", "raid_outcome")
    return [missing(c) for c in required] + [outside(c, 0, None) for c in measures] + [
        not_matching("raid_id", C.RAID_ID_PATTERN),
        outside("n_players", 1, 40),
        outside("boss_min_hp_pct", 0, 100),
        not_one_of("raid_outcome", C.RAID_OUTCOMES),
        Rule("composition", "n_players", "n_tanks + n_healers + n_dps > n_players"),
    ]


def player_stats_rules() -> list[Rule]:
    measures = ("damage_total", "healing_total", "damage_events", "healing_events",
                "player_deaths", "crit_events", "total_damage_received", "dps", "hps")
    fractions = ("crit_rate", "damage_share", "healing_share")
    labels = ("raid_id", "event_date", "player_id", "player_name", "player_class", "player_role")
    return (
        [missing(c) for c in (*labels, *measures, *fractions)]
        + [outside(c, 0, None) for c in measures]
        + [outside(c, 0, 1) for c in fractions]
        + [
            not_matching("raid_id", C.RAID_ID_PATTERN),
            wrong_length("player_id", 1, None),
            wrong_length("player_name", 1, 12),
            wrong_length("player_class", 1, None),
            not_one_of("player_role", C.GOLD_ROLES, ignore_case=True),
        ]
    )


def impact_rules() -> list[Rule]:
    required = ("raid_id", "event_date", "player_id", "player_name", "impact_score", "impact_rank")
    return [missing(c) for c in required] + [
        not_matching("raid_id", C.RAID_ID_PATTERN),
        wrong_length("player_id", 1, None),
        wrong_length("player_name", 1, 12),
        outside("impact_score", 0, 100),
        outside("impact_rank", 1, None),
        not_one_of("style_cluster", C.PLAYER_STYLES),
    ]


GOLD_RULES = {
    "dim_player": dim_player_rules,
    "dim_raid": dim_raid_rules,
    "fact_raid_summary": raid_summary_rules,
    "fact_player_raid_stats": player_stats_rules,
    "player_impact_index": impact_rules,
}


def conform(frame: DataFrame, table: str) -> DataFrame:
    """Normalisations the contract applies to accepted values."""
    if table in ("dim_player", "fact_player_raid_stats"):
        frame = frame.withColumn("player_role", F.lower("player_role"))
    if table == "fact_player_raid_stats":
        frame = frame.withColumn("crit_rate", F.round("crit_rate", 6))
    if table == "dim_raid":
        frame = frame.withColumn(
            "difficulty", F.coalesce("difficulty", F.lit(C.DEFAULT_DIFFICULTY))
        )
    return frame


# --- evaluation ------------------------------------------------------------------------


def breaks_any(rules: Sequence[Rule]) -> Column:
    """True when a row breaks at least one rule; stops at the first one."""
    return F.expr(" OR ".join(f"coalesce({r.broken}, false)" for r in rules))


def mark(frame: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add ``errors``, the broken rules of each row, and ``_broken``, whether there are any.

    The flag has its own short-circuit expression, so a plan that only needs the flag
    never builds the arrays.
    """
    entries = ", ".join(
        f"if({r.broken}, named_struct('rule', '{r.rule}', 'column', '{r.column}'), NULL)"
        for r in rules
    )
    return frame.withColumns({
        ERRORS: F.expr(f"filter(array({entries}), e -> e IS NOT NULL)"),
        BROKEN: breaks_any(rules),
    })


def is_broken() -> Column:
    return F.col(BROKEN)


def split(marked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid rows (as they came) and rejects (with ``errors``)."""
    valid = marked.filter(~is_broken()).drop(ERRORS, BROKEN)
    return valid, marked.filter(is_broken()).drop(BROKEN)


def error_counts(frame: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Broken rows per rule and column: one pass with one counter per rule."""
    counters = frame.agg(*[
        F.expr(f"count_if(coalesce({r.broken}, false)) AS _c{i}") for i, r in enumerate(rules)
    ])
    rows = ", ".join(
        f"named_struct('rule', '{r.rule}', 'column', '{r.column}', 'broken_rows', _c{i})"
        for i, r in enumerate(rules)
    )
    return counters.selectExpr(f"inline(array({rows}))").filter("broken_rows > 0")


def enforce_all(frames: dict[str, DataFrame]) -> None:
    """Raise with every broken rule of every table; all tables are checked in one job.

    The usual case, nothing broken, needs one counter per table.  Only tables with broken
    rows are counted rule by rule, and one row per broken rule reaches the driver.
    """
    def stacked(parts: list[DataFrame]) -> DataFrame:
        return reduce(DataFrame.unionByName, parts)

    suspects = stacked([
        frame.agg(F.count_if(breaks_any(GOLD_RULES[table]())).alias("rows")).withColumn(
            "table", F.lit(table)
        )
        for table, frame in frames.items()
    ]).filter(F.col("rows") > 0)
    tables = [row["table"] for row in suspects.collect()]
    if not tables:
        return
    broken: dict[str, dict] = {}
    counted = stacked([
        error_counts(frames[table], GOLD_RULES[table]()).withColumn("table", F.lit(table))
        for table in tables
    ])
    for row in counted.collect():
        broken.setdefault(row["table"], {})[(row["rule"], row["column"])] = row["broken_rows"]
    raise ContractError(broken)


def enforce(frame: DataFrame, table: str) -> DataFrame:
    """The conformed table, or ContractError."""
    enforce_all({table: frame})
    return conform(frame, table)


# --- batches ---------------------------------------------------------------------------


def batch_verdict(
    marked: DataFrame, batch: str = "batch_id", max_events: int = C.MAX_EVENTS_PER_BATCH
) -> DataFrame:
    """All-or-nothing verdict per batch: counts, status and the reasons against it.

    Counting by (batch, raid) first keeps the distinct count of raids an ordinary sum.
    """
    per_raid = marked.groupBy(batch, "raid_id").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(is_broken()).alias("bad")
    )
    counted = per_raid.groupBy(batch).agg(
        F.sum("rows").alias("event_count"),
        F.sum("bad").alias("invalid_count"),
        F.count("raid_id").alias("raid_count"),
    )
    reasons = F.filter(
        F.array(
            F.when(F.col("invalid_count") > 0, F.lit("invalid_events")),
            F.when(F.col("event_count") > max_events, F.lit("too_many_events")),
            F.when(F.col("raid_count") > 1, F.lit("mixed_raids")),
        ),
        lambda r: r.isNotNull(),
    )
    return counted.select(
        batch,
        "event_count",
        (F.col("event_count") - F.col("invalid_count")).alias("valid_count"),
        "invalid_count",
        "raid_count",
        F.when(F.size(reasons) == 0, "accepted").otherwise("rejected").alias("status"),
        F.array_join(reasons, ",").alias("reasons"),
    )


def admit(
    marked: DataFrame, mode: str = "batch", batch: str = "batch_id",
    max_events: int = C.MAX_EVENTS_PER_BATCH,
) -> DataFrame:
    """Add ``accepted``: by whole batch, or row by row.

    The verdicts are joined without a hint; the adaptive planner broadcasts them when
    they measure small and splits an oversized batch when they do not.
    """
    if mode == "row":
        return marked.withColumn("accepted", ~is_broken())
    if mode != "batch":
        raise ValueError(f"mode must be 'batch' or 'row', not {mode!r}")
    verdict = batch_verdict(marked, batch, max_events).select(
        batch, (F.col("status") == "accepted").alias("accepted")
    )
    joined = marked.join(verdict, batch, "left")
    # Rows without a batch id have no verdict and are not accepted.
    return joined.withColumn("accepted", F.coalesce("accepted", F.lit(False)))


def first_errors(
    marked: DataFrame, n: int = C.ERRORS_REPORTED_PER_BATCH,
    batch: str = "batch_id", index: str = "idx", event: str = "event_id",
) -> DataFrame:
    """The first ``n`` broken events of each batch, by position in the batch.

    The rank limit is applied in each map task before the shuffle, so a batch of any
    size sends at most ``n`` rows per task.
    """
    order = W.partitionBy(batch).orderBy(index, event)
    return (
        marked.filter(is_broken())
        .withColumn("error_rank", F.row_number().over(order))
        .filter(F.col("error_rank") <= n)
        .select(
            batch, index, event, F.col("error_rank").cast("bigint").alias("error_rank"),
            F.array_join(
                F.transform(ERRORS, lambda e: F.concat(e["rule"], F.lit(":"), e["column"])), ","
            ).alias("broken_rules"),
        )
    )

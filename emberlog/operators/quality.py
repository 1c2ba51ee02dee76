"""Data-quality and coherence checks.

Each check yields rows ``check_id, scope, status, observed, expected`` with status ``ok``,
``warn`` or ``fail``.  Checks over one table share one aggregation of it.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlog import constants as C
from emberlog.functions.coercion import unknown_if_null
from emberlog.functions.numbers import readable_bytes, reduction_pct
from emberlog.operators.profile import stack_tables

COLUMNS = ("check_id", "scope", "status", "observed", "expected")


def _row(check: str, scope: Column, status: Column, observed: Column, expected: str) -> Column:
    return F.struct(
        F.lit(check).alias("check_id"),
        scope.cast("string").alias("scope"),
        status.alias("status"),
        observed.cast("string").alias("observed"),
        F.lit(expected).alias("expected"),
    )


def _rows(frame: DataFrame, *checks: Column) -> DataFrame:
    return frame.select(F.inline(F.array(*checks)))


def ok_if(passed: Column, otherwise: str = "fail") -> Column:
    return F.when(F.coalesce(passed, F.lit(False)), "ok").otherwise(otherwise)


def orphan_players(stats: DataFrame, dim_player: DataFrame) -> DataFrame:
    """Fact participants the dimension does not hold."""
    return (
        stats.select("player_id").distinct().join(dim_player.select("player_id"), "player_id", "left_anti")
    )


def unmatched_raids(summary: DataFrame, dim_raid: DataFrame) -> DataFrame:
    """Raids that only one side holds."""
    facts, dims = summary.select("raid_id"), dim_raid.select("raid_id")
    return (
        facts.join(dims, "raid_id", "left_anti").withColumn("only_in", F.lit("fact"))
        .unionByName(dims.join(facts, "raid_id", "left_anti").withColumn("only_in", F.lit("dim")))
    )


def _empty_is_ok(check: str, offending: DataFrame, expected: str) -> DataFrame:
    counted = offending.agg(F.count(F.lit(1)).alias("n"))
    return _rows(
        counted, _row(check, F.lit("all"), ok_if(F.col("n") == 0), F.col("n"), expected)
    )


def check_player_keys(stats: DataFrame, dim_player: DataFrame) -> DataFrame:
    return _empty_is_ok("player_fk", orphan_players(stats, dim_player), "0 orphan players")


def check_raid_keys(summary: DataFrame, dim_raid: DataFrame) -> DataFrame:
    return _empty_is_ok("raid_fk", unmatched_raids(summary, dim_raid), "0 unmatched raids")


def check_shares(stats: DataFrame, tolerance: float = C.SHARE_TOLERANCE) -> DataFrame:
    """Shares of each raid add up to 1; a raid without any warns."""
    sums = stats.groupBy("raid_id").agg(
        F.sum("damage_share").alias("damage"), F.sum("healing_share").alias("healing")
    )

    def row(check: str, name: str) -> Column:
        value = F.col(name)
        status = F.when(value == 0, "warn").otherwise(ok_if(F.abs(value - 1.0) < tolerance))
        return _row(check, F.col("raid_id"), status, F.round(value, 4), "1")

    return _rows(sums, row("damage_share", "damage"), row("healing_share", "healing"))


def check_summaries(summary: DataFrame) -> DataFrame:
    """Role sum and boss health of each raid."""
    roles = F.col("n_tanks") + F.col("n_healers") + F.col("n_dps")
    hp = F.col("boss_min_hp_pct")
    return _rows(
        summary,
        _row("roles", F.col("raid_id"), ok_if(roles <= F.col("n_players")), roles, "<= n_players"),
        _row("boss_hp", F.col("raid_id"), ok_if((hp >= 0) & (hp <= 100)), hp, "0..100"),
    )


def check_stats(stats: DataFrame) -> DataFrame:
    """Crit rates in 0..1, no negative rates, per raid; labels known, over all."""
    counted = stats.groupBy("raid_id").agg(
        F.count_if((F.col("crit_rate") < 0) | (F.col("crit_rate") > 1)).alias("crit"),
        F.count_if(F.col("dps") < 0).alias("dps"),
        F.count_if(F.col("hps") < 0).alias("hps"),
    )
    raid = F.col("raid_id")
    negative = F.col("dps") + F.col("hps")
    return _rows(
        counted,
        _row("crit_rate", raid, ok_if(F.col("crit") == 0), F.col("crit"), "0 rows outside 0..1"),
        _row("rates", raid, ok_if(negative == 0), negative, "0 negative rates"),
    )


def check_raid_size(summary: DataFrame, dim_raid: DataFrame) -> DataFrame:
    """No raid has more participants than its registered size; an unregistered raid fails."""
    joined = summary.select("raid_id", "n_players").join(
        dim_raid.select("raid_id", "raid_size"), "raid_id", "left"
    )
    fits = F.coalesce(F.col("n_players") <= F.col("raid_size"), F.lit(False))
    return _rows(
        joined,
        _row("raid_size", F.col("raid_id"), ok_if(fits),
             F.col("n_players"), "<= raid_size"),
    )


def check_labels(frame: DataFrame, columns: Sequence[str] = ("player_class", "player_role")) -> DataFrame:
    """Warn about unknown or null labels."""
    counted = frame.agg(*[
        F.count_if(unknown_if_null(F.col(c)) == "unknown").alias(c) for c in columns
    ])
    return _rows(
        counted,
        *[
            _row(f"known_{c}", F.lit("all"), ok_if(F.col(c) == 0, "warn"), F.col(c), "0 unknown")
            for c in columns
        ],
    )


def coherence(
    summary: DataFrame, stats: DataFrame, dim_player: DataFrame, dim_raid: DataFrame
) -> DataFrame:
    """Every check of a finished analytical layer."""
    return stack_tables(
        check_player_keys(stats, dim_player),
        check_raid_keys(summary, dim_raid),
        check_shares(stats),
        check_summaries(summary),
        check_stats(stats),
        check_raid_size(summary, dim_raid),
        check_labels(dim_player),
    )


def verdict(checks: DataFrame) -> DataFrame:
    """Checks passed, warned and failed."""
    return checks.groupBy("status").agg(F.count(F.lit(1)).alias("checks"))


def reconcile(source: DataFrame, target: DataFrame, name: str) -> DataFrame:
    """Row counts of two layers and their difference."""
    rows_in = source.agg(F.count(F.lit(1)).alias("source_rows"))
    rows_out = target.agg(F.count(F.lit(1)).alias("target_rows"))
    return reconcile_counts(rows_in.withColumn("target_rows", rows_out.scalar()), name)


def reconcile_counts(counts: DataFrame, name: str) -> DataFrame:
    """The same from one row of ``source_rows`` and ``target_rows``, however they were counted."""
    return counts.select(
        F.lit(name).alias("layer"),
        "source_rows",
        "target_rows",
        F.abs(F.col("source_rows") - F.col("target_rows")).alias("difference"),
        ok_if(F.col("source_rows") == F.col("target_rows")).alias("status"),
    )


def check_dataset(
    events: DataFrame,
    raids: int = C.CHECKPOINT_RAIDS,
    min_events: int = C.CHECKPOINT_MIN_EVENTS,
    event_type: str = C.CHECKPOINT_EVENT_TYPE,
    min_share: float = C.CHECKPOINT_MIN_SHARE,
    min_phases: int = C.CHECKPOINT_MIN_PHASES,
) -> DataFrame:
    """Checkpoints of a raw data set: raids, volume, presence, share, boss phases."""
    per_raid = events.groupBy("raid_id").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("event_type") == event_type).alias("wanted"),
        F.count_if(F.col("event_type") == "boss_phase").alias("phases"),
    )
    t = per_raid.agg(
        F.count("raid_id").alias("raids"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum("wanted"), F.lit(0)).alias("wanted"),
        F.coalesce(F.sum("phases"), F.lit(0)).alias("phases"),
    )
    share = F.col("wanted") / F.greatest(F.col("rows"), F.lit(1))
    scope = F.lit("all")
    return _rows(
        t,
        _row("raids", scope, ok_if(F.col("raids") == raids), F.col("raids"), str(raids)),
        _row("volume", scope, ok_if(F.col("rows") >= min_events), F.col("rows"), f">= {min_events}"),
        _row("type_present", scope, ok_if(F.col("wanted") > 0), F.col("wanted"), event_type),
        _row("type_share", scope, ok_if(share > min_share), F.round(share, 4), f"> {min_share}"),
        _row("phases", scope, ok_if(F.col("phases") >= min_phases), F.col("phases"),
             f">= {min_phases}"),
    )


def class_roles(spark: SparkSession) -> DataFrame:
    """The fixed class, specialisation and role reference (34 rows)."""
    return spark.createDataFrame(
        list(C.CLASS_SPEC_ROLES), "player_class string, spec string, player_role string"
    )


def class_role_conformity(events: DataFrame, reference: DataFrame | None = None) -> DataFrame:
    """Class and role pairs of the events, and whether the reference allows them.

    The pairs are counted before the join, so only distinct combinations meet the
    reference.
    """
    reference = class_roles(events.sparkSession) if reference is None else reference
    allowed = reference.select(
        F.col("player_class").alias("source_player_class"),
        F.col("player_role").alias("source_player_role"),
    ).distinct().withColumn("_known", F.lit(True))
    pairs = (
        events.filter(
            F.col("source_player_class").isNotNull() & F.col("source_player_role").isNotNull()
        )
        .groupBy("source_player_class", "source_player_role")
        .agg(F.count(F.lit(1)).alias("events"))
    )
    return pairs.join(allowed, ["source_player_class", "source_player_role"], "left").select(
        "source_player_class", "source_player_role", "events",
        F.coalesce("_known", F.lit(False)).alias("allowed"),
    )


def check_reference(reference: DataFrame, weights: DataFrame, tolerance: float = 1e-9) -> DataFrame:
    """Reference invariants: entries per role, and weights that sum to 1 per key.

    ``weights`` has the columns ``key`` and ``weight``.
    """
    roles = reference.groupBy("player_role").agg(F.count(F.lit(1)).alias("n"))
    role_rows = _rows(
        roles, _row("role_entries", F.col("player_role"), ok_if(F.col("n") > 0), F.col("n"), "> 0")
    )
    sums = weights.groupBy("key").agg(F.sum("weight").alias("w"))
    return role_rows.unionByName(_rows(
        sums,
        _row("weight_sum", F.col("key"), ok_if(F.abs(F.col("w") - 1.0) < tolerance), F.col("w"), "1"),
    ))


def check_order(disorder: DataFrame, min_events: int = 1) -> DataFrame:
    """Checks over the result of ``timeline.out_of_order``."""
    raid = F.col("raid_id")
    return _rows(
        disorder,
        _row("unique_ids", raid, ok_if(F.col("repeated_ids") == 0), F.col("repeated_ids"), "0"),
        _row("time_order", raid, ok_if(F.col("out_of_order") == 0), F.col("out_of_order"), "0"),
        _row("enough_events", raid, ok_if(F.col("events") >= min_events), F.col("events"),
             f">= {min_events}"),
    )


def check_columns(frame: DataFrame, required: Sequence[str]) -> DataFrame:
    """Required columns exist and there is at least one row."""
    absent = [c for c in required if c not in frame.columns]
    counted = frame.limit(1).agg(F.count(F.lit(1)).alias("n"))
    return _rows(
        counted,
        _row("columns", F.lit("all"), ok_if(F.lit(not absent)), F.lit(",".join(absent)), "none absent"),
        _row("has_rows", F.lit("all"), ok_if(F.col("n") > 0), F.col("n"), "> 0"),
    )


def schema_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """Columns added, removed or retyped between two layers.

    Reads schemas only; the rows are as many as there are columns.
    """
    old = {f.name: f.dataType.simpleString() for f in before.schema.fields}
    new = {f.name: f.dataType.simpleString() for f in after.schema.fields}
    rows = []
    for name in sorted(old.keys() | new.keys()):
        if name not in old:
            rows.append((name, "added", None, new[name]))
        elif name not in new:
            rows.append((name, "removed", old[name], None))
        elif old[name] != new[name]:
            rows.append((name, "retyped", old[name], new[name]))
    return before.sparkSession.createDataFrame(
        rows, "column string, change string, type_before string, type_after string"
    )


def layer_comparison(
    before: DataFrame, after: DataFrame, files_before: DataFrame, files_after: DataFrame
) -> DataFrame:
    """Two written layers in one report: schema, sizes, rows and massive hits.

    Rows are ``aspect, item, before, after``.  Both layers are counted by one scan of a few
    columns each; files and bytes come from their listings.
    """
    changes = schema_changes(before, after).select(
        F.lit("column").alias("aspect"), F.col("column").alias("item"),
        F.coalesce("type_before", F.lit("absent")).alias("before"),
        F.coalesce("type_after", F.lit("absent")).alias("after"),
    )
    sizes = size_change(files_before, files_after)
    text = lambda name: F.col(name).cast("string")
    listed = _report(sizes, ("files", "files", text("files_before"), text("files_after")),
                     ("size", "bytes", text("bytes_before"), text("bytes_after")),
                     ("size", "reduction_pct", F.lit(None).cast("string"), F.round("reduction_pct", 1).cast("string")))

    def counted(frame: DataFrame) -> DataFrame:
        hits = F.count_if("is_massive_hit") if "is_massive_hit" in frame.columns else F.lit(None).cast("bigint")
        return frame.agg(F.count(F.lit(1)).alias("n"), hits.alias("hits"))

    old, new = counted(before), counted(after)
    both = old.withColumnsRenamed({"n": "n_before", "hits": "hits_before"}).withColumns({
        "n_after": new.select("n").scalar(), "hits_after": new.select("hits").scalar()})
    rows = _report(both, ("rows", "rows", text("n_before"), text("n_after")),
                   ("rows", "massive_hits", text("hits_before"), text("hits_after")))
    return stack_tables(changes, listed, rows)


def _report(frame: DataFrame, *rows: tuple[str, str, Column, Column]) -> DataFrame:
    return frame.select(F.inline(F.array(*[
        F.struct(F.lit(aspect).alias("aspect"), F.lit(item).alias("item"), old.alias("before"), new.alias("after"))
        for aspect, item, old, new in rows
    ])))


def size_change(before: DataFrame, after: DataFrame) -> DataFrame:
    """Files and bytes of two layers (from ``files.inventory``) and the size saved."""
    old = before.agg(F.count(F.lit(1)).alias("files_before"), F.sum("length").alias("bytes_before"))
    new = after.agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("b"))
    return old.withColumns({
        "files_after": new.select("n").scalar(), "bytes_after": new.select("b").scalar(),
    }).withColumns({
        "size_before": readable_bytes(F.col("bytes_before")),
        "size_after": readable_bytes(F.col("bytes_after")),
        "reduction_pct": reduction_pct(F.col("bytes_before"), F.col("bytes_after")),
    })

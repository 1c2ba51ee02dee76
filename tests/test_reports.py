"""Rankings, profiles and checks."""

from datetime import date, datetime

import pytest

from emberlog import constants as C
from emberlog.functions import numbers
from emberlog.operators import profile, quality, ranking
from emberlog.schemas import DIM_PLAYER_SCHEMA, DIM_RAID_SCHEMA, PLAYER_STATS_SCHEMA, RAID_SUMMARY_SCHEMA
from pyspark.sql import functions as F

DAY = date(2026, 1, 1)


def stats(spark, *rows):
    base = {f.name: 0.0 if f.dataType.simpleString() == "double" else 0
            for f in PLAYER_STATS_SCHEMA.fields}
    base |= {"raid_id": "raid001", "event_date": DAY, "player_name": "N", "player_class": "mage",
             "player_role": "dps"}
    return spark.createDataFrame(
        [tuple({**base, **r}[f.name] for f in PLAYER_STATS_SCHEMA.fields) for r in rows],
        PLAYER_STATS_SCHEMA)


def summary(spark, **change):
    base = {"raid_id": "raid001", "event_date": DAY, "duration_ms": 1.0, "total_damage": 1.0,
            "total_healing": 1.0, "total_player_deaths": 0, "n_players": 2, "n_tanks": 1,
            "n_healers": 1, "n_dps": 0, "raid_dps": 1.0, "raid_hps": 1.0, "boss_min_hp_pct": 0.0,
            "raid_outcome": "success", **change}
    return spark.createDataFrame(
        [tuple(base[f.name] for f in RAID_SUMMARY_SCHEMA.fields)], RAID_SUMMARY_SCHEMA)


def test_impact(spark):
    frame = stats(
        spark,
        {"player_id": "a", "damage_share": 1.0, "healing_share": 1.0, "crit_rate": 1.0},
        {"player_id": "b", "damage_share": 0.5, "player_deaths": 1},
        {"player_id": "c", "player_deaths": 9},
        {"player_id": "d", "damage_share": 0.5, "player_deaths": 1},
    )
    got = [(r.player_id, round(r.impact_score, 6), r.impact_rank, r.impact_band)
           for r in ranking.impact_index(frame).orderBy("impact_rank").collect()]
    assert got == [("a", 85.0, 1, "core"), ("b", 16.5, 2, "low"), ("d", 16.5, 3, "low"),
                   ("c", 0.0, 4, "low")]


def test_top_lists(spark):
    frame = stats(
        spark,
        {"player_id": "a", "dps": 5.0, "hps": 0.0, "player_deaths": 0, "damage_events": 1, "crit_rate": 0.1},
        {"player_id": "b", "dps": 9.0, "hps": 2.0, "player_deaths": 3, "crit_rate": 0.9},
        {"player_id": "c", "dps": 9.0, "hps": 1.0, "player_deaths": 1, "healing_events": 2, "crit_rate": 0.2},
        {"player_id": "d", "dps": 1.0, "raid_id": "raid002"},
    )

    def ids(result):
        return [r.player_id for r in result.orderBy("raid_id", "place").collect()]

    assert ids(ranking.top_dps(frame, 2)) == ["b", "c", "d"]
    assert ids(ranking.top_hps(frame)) == ["b", "c"]
    assert ids(ranking.most_deaths(frame)) == ["b", "c"]
    assert ids(ranking.top_crit(frame)) == ["c", "a"]
    assert [r.player_id for r in ranking.top_overall(frame, "dps", 2).collect()] == ["b", "c"]
    plan = ranking.top_dps(frame)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_shares_need_no_window(sample):
    shares = profile.event_types(sample)
    assert abs(shares.agg(F.sum("pct")).first()[0] - 100.0) < 1e-9
    assert "Window" not in shares._jdf.queryExecution().executedPlan().toString()


def test_amounts_leave_out_zero_and_null(make_events):
    rows = [{"event_id": str(i), "event_type": "combat_damage", "damage_amount": v}
            for i, v in enumerate([0.0, None, 2.0, 4.0])]
    got = profile.amount_profile(make_events(*rows)).first()
    assert (got.damage_rows, got.damage_mean, got.damage_min, got.damage_max) == (2, 3.0, 2.0, 4.0)
    assert round(got.damage_stdev, 6) == 1.414214 and got.heal_mean is None


def test_coherence_finds_what_is_wrong(spark):
    facts = summary(spark, n_tanks=5, boss_min_hp_pct=101.0, n_players=3)
    people = stats(
        spark,
        {"player_id": "a", "damage_share": 0.5, "healing_share": 0.0, "crit_rate": 1.5, "dps": -1.0},
        {"player_id": "ghost", "damage_share": 0.2})
    players = spark.createDataFrame([("a", "A", "unknown", "dps", DAY, DAY, 1)], DIM_PLAYER_SCHEMA)
    raids = spark.createDataFrame([("raid001", DAY, "B", "Normal", 2, 1.0)], DIM_RAID_SCHEMA)
    got = {r.check_id: r.status for r in quality.coherence(facts, people, players, raids).collect()}
    assert got == {
        "player_fk": "fail", "raid_fk": "ok", "damage_share": "fail", "healing_share": "warn",
        "roles": "fail", "boss_hp": "fail", "crit_rate": "fail", "rates": "fail",
        "raid_size": "fail", "known_player_class": "warn", "known_player_role": "ok"}
    assert [r.player_id for r in quality.orphan_players(people, players).collect()] == ["ghost"]


def test_consolidated_view_flags(spark):
    raids = spark.createDataFrame(
        [("raid001", DAY, "A boss with a long name", "Normal", 1, 1.0)], DIM_RAID_SCHEMA)
    row = profile.consolidated_raids(summary(spark), raids, stats(
        spark, {"player_id": "a", "damage_share": 0.995})).first()
    assert row.boss_name.startswith("A boss with a lo") and len(row.boss_name) > 16 and row.players == "2/1"
    assert (row.fk_raid_ok, row.raid_size_ok, row.damage_share_ok, row.coherence_ok) == (
        True, False, True, False)


def test_reference_table(spark):
    reference = quality.class_roles(spark)
    counts = {r.player_role: r["count"] for r in reference.groupBy("player_role").count().collect()}
    assert counts == {"tank": 5, "healer": 6, "dps": 23} and len(C.CLASS_SPEC_ROLES) == 34
    weights = spark.createDataFrame([("k", 0.5), ("k", 0.5), ("bad", 0.9)], "key string, weight double")
    got = {r.scope: r.status for r in quality.check_reference(reference, weights).collect()}
    assert got == {"tank": "ok", "healer": "ok", "dps": "ok", "k": "ok", "bad": "fail"}


def test_class_role_pairs(make_events):
    events = make_events(
        {"event_id": "1", "source_player_class": "mage", "source_player_role": "dps"},
        {"event_id": "2", "source_player_class": "mage", "source_player_role": "tank"},
        {"event_id": "3", "source_player_class": None, "source_player_role": "tank"})
    got = {(r.source_player_role, r.allowed) for r in quality.class_role_conformity(events).collect()}
    assert got == {("dps", True), ("tank", False)}


def test_dataset_checks(make_events):
    events = make_events(*[
        {"event_id": str(i), "raid_id": "raid001", "event_type": "combat_damage", "timestamp": datetime(2026, 1, 1)}
        for i in range(3)])
    got = {r.check_id: r.status for r in quality.check_dataset(events, 1, 3, min_phases=1).collect()}
    assert got == {"raids": "ok", "volume": "ok", "type_present": "ok", "type_share": "ok", "phases": "fail"}
    empty = {r.check_id: r.status for r in quality.check_dataset(events.filter("false")).collect()}
    assert set(empty.values()) == {"fail"}


def test_stacking_and_merging(spark):
    left = spark.createDataFrame([("a", 1)], "k string, n bigint")
    right = spark.createDataFrame([("a", 2), ("b", 3)], "k string, n bigint")
    got = {r.k: r.n for r in profile.merge_counts(left, right, ["k"], "n").collect()}
    assert got == {"a": 3, "b": 3}
    stacked = profile.stack_tables(left, right.select("k"))
    assert stacked.filter("n IS NULL").count() == 2


@pytest.mark.parametrize("size, text", [
    (0, "0 B"), (1023, "1023 B"), (1024, "1.00 KB"), (1152, "1.12 KB"), (1536, "1.50 KB"),
    (5 * 1024 * 1024, "5.00 MB")])
def test_readable_bytes(spark, size, text):
    assert spark.range(1).select(numbers.readable_bytes(F.lit(size))).first()[0] == text


def test_numbers(spark):
    row = spark.range(1).select(
        numbers.ratio(F.lit(1), F.lit(0)).alias("a"), numbers.percent(F.lit(1), F.lit(4)).alias("b"),
        numbers.reduction_pct(F.lit(100), F.lit(15)).alias("c"),
        numbers.clamp(F.lit(120.0), 0.0, 100.0).alias("d"),
        numbers.minutes(F.lit(90000)).alias("e")).first()
    assert (row.a, row.b, round(row.c, 9), row.d, row.e) == (0.0, 25.0, 85.0, 100.0, 1.5)

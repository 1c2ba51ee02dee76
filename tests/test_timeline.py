from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from emberlog.operators import ordered, timeline
from pyspark.sql import functions as F

T0 = datetime(2026, 1, 1)


@pytest.fixture(autouse=True)
def many_slices(spark):
    """Keep small data in several slices, where it would otherwise be merged into one."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    yield
    spark.conf.set(key, "true")


def hits(make_events, amounts, raid="raid001", boss="boss_1", kind="boss"):
    return make_events(*[
        {"event_id": f"e{i:05d}", "raid_id": raid, "timestamp": T0 + timedelta(seconds=i // 2),
         "event_type": "combat_damage", "damage_amount": a, "target_entity_id": boss,
         "target_entity_type": kind}
        for i, a in enumerate(amounts)
    ])


def loop(amounts, max_hp, thresholds):
    left, phase, out = max_hp, 0, []
    for amount in amounts:
        if not amount:
            continue
        left = max(0.0, left - amount)
        pct = left / max_hp * 100.0
        stepped = phase < len(thresholds) and pct <= thresholds[phase]
        phase += stepped
        out.append((round(pct, 6), phase + 1, stepped))
    return out


def run(frame, max_hp, thresholds):
    rows = timeline.boss_timeline(frame, max_hp, thresholds).orderBy("hit").collect()
    return [(round(r.hp_pct_after, 6), r.phase, r.is_transition) for r in rows]


def test_phases_of_three_hits(make_events):
    got = run(hits(make_events, [310_000.0, 300_000.0, 1_000.0]), 1_000_000.0, (70.0, 40.0))
    assert got == [(69.0, 2, True), (39.0, 3, True), (38.9, 3, False)]


def test_one_step_per_hit_and_exact_threshold(make_events):
    assert run(hits(make_events, [90.0, 1.0, 1.0]), 100.0, (70.0, 40.0)) == [
        (10.0, 2, True), (9.0, 3, True), (8.0, 3, False)]
    assert run(hits(make_events, [30.0]), 100.0, (70.0, 40.0)) == [(70.0, 2, True)]
    # The second threshold is crossed, but there is no later hit to step on.
    assert run(hits(make_events, [95.0]), 100.0, (70.0, 40.0)) == [(5.0, 2, True)]


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(st.integers(0, 40).map(float), min_size=1, max_size=60),
    st.sampled_from([(70.0, 40.0), (90.0, 60.0, 30.0, 10.0), (50.0,)]),
)
def test_timeline_against_a_loop(make_events, amounts, thresholds):
    got = run(hits(make_events, amounts), 200.0, thresholds)
    assert got == loop(amounts, 200.0, thresholds)


def test_only_hits_on_a_boss_count_and_each_boss_has_its_own_health(make_events):
    events = hits(make_events, [40.0, 10.0]).unionByName(hits(make_events, [90.0], kind="player", boss="player_1")).unionByName(
        hits(make_events, [5.0, -3.0], boss="boss_2"))
    rows = timeline.boss_timeline(events, 100.0).orderBy("target_entity_id", "hit").collect()
    assert [(r.target_entity_id, r.hit, r.hp_pct_after) for r in rows] == [
        ("boss_1", 1, 60.0), ("boss_1", 2, 50.0), ("boss_2", 1, 95.0)]


def test_transitions(make_events):
    line = timeline.boss_timeline(hits(make_events, [40.0, 40.0, 5.0]), 100.0)
    got = timeline.boss_transitions(line).orderBy("phase").collect()
    assert [(r.phase, r.target_entity_health_pct_before, r.target_entity_health_pct_after, r.flag)
            for r in got] == [(2, 100.0, 60.0, "boss_phase_2"), (3, 60.0, 20.0, "boss_phase_3")]


def test_chunks(make_events):
    got = timeline.chunked(hits(make_events, [1.0] * 7), 3).orderBy("seq").collect()
    assert [(r.seq, r.chunk) for r in got] == [(1, 1), (2, 1), (3, 1), (4, 2), (5, 2), (6, 2), (7, 3)]


def test_elapsed(make_events):
    got = timeline.elapsed(hits(make_events, [1.0] * 4)).orderBy("event_id").collect()
    assert [r.elapsed_ms for r in got] == [0, 0, 1000, 1000]


def test_disorder(make_events):
    events = make_events(*[
        {"event_id": e, "raid_id": "raid001", "timestamp": T0 + timedelta(seconds=s), "idx": i}
        for i, (e, s) in enumerate([("a", 0), ("b", 5), ("c", 3), ("c", 4), ("d", 9)])
    ])
    got = timeline.out_of_order(events, ["raid_id"], ["idx"]).first()
    assert (got.events, got.repeated_ids, got.out_of_order) == (5, 1, 1)


def test_a_dominant_group_spreads_over_slices(spark):
    """One raid with most rows: exact running values, and no slice holding all of it."""
    frame = spark.range(0, 20000, 1, 4).select(
        F.when(F.col("id") % 10 == 0, "cold").otherwise("hot").alias("raid_id"),
        (F.col("id") * 7919 % 20011).alias("at"), F.lit(1.5).alias("x"))
    running = ordered.with_running(
        frame, ["raid_id"], [F.col("at")], sums={"total": ("x", "decimal(20,2)")})
    got = running.groupBy("raid_id").agg(
        F.count("*").alias("n"), F.max("seq").alias("last"), F.countDistinct("seq").alias("seqs"),
        F.max("total").alias("total")).orderBy("raid_id").collect()
    assert [(r.raid_id, r.n, r.last, r.seqs, float(r.total)) for r in got] == [
        ("cold", 2000, 2000, 2000, 3000.0), ("hot", 18000, 18000, 18000, 27000.0)]
    assert running.filter("total <> seq * 1.5").isEmpty()
    rows = ordered.sliced(frame, ["raid_id"], [F.col("at")])
    sizes = rows.filter("raid_id = 'hot'").groupBy(ordered.SLICE).count().collect()
    assert len(sizes) > 1


def test_rows_without_a_group_stay(spark):
    frame = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "raid_id string, at bigint")
    got = ordered.with_running(frame, ["raid_id"], [F.col("at")]).collect()
    assert sorted((r.at, r.seq) for r in got) == [(1, 1), (2, 2), (3, 1)]


def test_previous_value_crosses_slices(spark):
    frame = spark.range(0, 5000, 1, 4).select(
        F.lit("r").alias("raid_id"), F.col("id").alias("at"), (F.col("id") * 2).alias("x"))
    got = ordered.with_previous(frame, ["raid_id"], [F.col("at")], "x", "before")
    assert got.filter("at > 0 AND (before IS NULL OR before <> (at - 1) * 2)").isEmpty()
    assert got.filter("before IS NULL").count() == 1


def test_thresholds_may_be_empty(make_events):
    assert run(hits(make_events, [10.0]), 100.0, ()) == [(90.0, 1, False)]

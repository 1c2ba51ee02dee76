from datetime import date, datetime, timedelta

import pytest

from emberlog.operators import dimensions, facts

START = datetime(2026, 1, 1, 20, 0, 0)


def event(seconds, kind, source, role, **more):
    return {
        "raid_id": "raid001", "timestamp": START + timedelta(seconds=seconds),
        "event_date": "2026-01-01", "event_type": kind, "source_player_id": source,
        "source_player_role": role, "event_id": f"{source}-{seconds}", **more,
    }


def success_rows():
    return [
        event(0, "combat_damage", "player1", "dps", damage_amount=15000.0,
              target_entity_type="boss", target_entity_id="boss", is_critical_hit=True,
              target_entity_health_pct_after=0.0, source_player_name="Alice",
              source_player_class="mage"),
        event(1, "heal", "player2", "healer", healing_amount=5000.0, target_entity_type="player",
              target_entity_id="player1", source_player_name="Bob", source_player_class="priest",
              is_critical_hit=False),
        event(2, "player_death", "player2", "healer", target_entity_type="player",
              source_player_name="Bob", source_player_class="priest", is_critical_hit=False),
    ]


def test_kill_in_time_is_a_success(make_events):
    row = facts.raid_summary(make_events(*success_rows())).collect()
    assert len(row) == 1
    row = row[0]
    assert (row.total_damage, row.total_healing, row.total_player_deaths) == (15000.0, 5000.0, 1)
    assert (row.n_players, row.n_tanks, row.n_healers, row.n_dps) == (2, 0, 1, 1)
    assert row.boss_min_hp_pct == 0.0 and row.raid_outcome == "success"
    assert row.event_date == date(2026, 1, 1) and row.duration_ms == 2000.0
    assert row.raid_dps == 7500.0 and row.raid_hps == 2500.0


def test_many_deaths_and_a_living_boss_is_a_wipe(make_events):
    rows = [
        event(0, "combat_damage", "player1", "dps", damage_amount=8000.0,
              target_entity_type="boss", target_entity_health_pct_after=50.0),
        event(1, "heal", "player2", "healer", healing_amount=3000.0, target_entity_type="player"),
    ] + [
        event(2 + i, "player_death", f"player{1 + i % 2}", "dps" if i % 2 == 0 else "healer",
              target_entity_type="player")
        for i in range(4)
    ]
    row = facts.raid_summary(make_events(*rows)).first()
    assert (row.total_player_deaths, row.n_players) == (4, 2)
    assert (row.n_healers, row.n_dps) == (1, 1)
    assert row.boss_min_hp_pct == 50.0 and row.raid_outcome == "wipe"


def test_player_stats(make_events):
    rows = {r.player_name: r for r in facts.player_raid_stats(make_events(*success_rows())).collect()}
    alice, bob = rows["Alice"], rows["Bob"]
    assert (alice.damage_total, alice.damage_events, alice.crit_events) == (15000.0, 1, 1)
    assert (alice.crit_rate, alice.damage_share, alice.player_deaths) == (1.0, 1.0, 0)
    assert alice.dps == 7500.0
    assert (bob.healing_total, bob.healing_events, bob.crit_events) == (5000.0, 1, 0)
    assert (bob.healing_share, bob.player_deaths, bob.damage_share) == (1.0, 1, 0.0)
    assert bob.hps == 2500.0


@pytest.mark.parametrize("hp, duration_s, deaths, outcome", [
    (0.0, 360, 5, "success"),
    (0.0, 361, 5, "wipe"),
    (9.9, 900, 1, "success"),
    (10.0, 900, 0, "wipe"),
])
def test_outcome_limits(make_events, hp, duration_s, deaths, outcome):
    rows = [
        event(0, "combat_damage", "a", "dps", damage_amount=1.0, target_entity_type="boss",
              target_entity_health_pct_after=hp),
        event(duration_s, "spell_cast", "a", "dps"),
    ] + [event(1, "player_death", "a", "dps") for _ in range(deaths)]
    assert facts.raid_summary(make_events(*rows)).first().raid_outcome == outcome


def test_zero_duration_no_boss_no_damage(make_events):
    row = facts.raid_summary(make_events(event(0, "spell_cast", "a", "dps"))).first()
    assert (row.duration_ms, row.raid_dps, row.raid_hps) == (0.0, 0.0, 0.0)
    assert (row.total_damage, row.boss_min_hp_pct) == (0.0, 100.0)
    stats = facts.player_raid_stats(make_events(event(0, "spell_cast", "a", "dps"))).first()
    assert (stats.damage_share, stats.crit_rate, stats.dps) == (0.0, 0.0, 0.0)


def test_role_change_counts_in_both_roles(make_events):
    row = facts.raid_summary(make_events(
        event(0, "spell_cast", "a", "dps"), event(1, "spell_cast", "a", "healer"),
    )).first()
    assert (row.n_players, row.n_dps, row.n_healers) == (1, 1, 1)


def test_first_label_skips_nulls_and_follows_time(make_events):
    stats = facts.player_raid_stats(make_events(
        event(5, "spell_cast", "a", "tank", source_player_name="Late"),
        event(1, "spell_cast", "a", None, source_player_name="Early"),
        event(3, "spell_cast", "a", "dps", source_player_name="Middle"),
    )).first()
    assert (stats.player_name, stats.player_role) == ("Early", "dps")


def test_bosses_count_only_without_a_prefix(make_events):
    rows = [
        event(0, "combat_damage", "player_1", "dps", damage_amount=10.0),
        event(9, "player_death", "boss_1", None, target_entity_id="player_1"),
    ]
    with_prefix = facts.raid_summary(make_events(*rows), "player_").first()
    everyone = facts.raid_summary(make_events(*rows)).first()
    assert (with_prefix.n_players, everyone.n_players) == (1, 2)
    assert with_prefix.total_player_deaths == everyone.total_player_deaths == 1
    assert (with_prefix.duration_ms, everyone.duration_ms) == (0.0, 9000.0)
    by_target = facts.player_raid_stats(
        make_events(*rows), None, "player_", victim="target_entity_id").collect()
    assert [(r.player_id, r.player_deaths) for r in by_target] == [("player_1", 1)]


def test_raid_without_participants_is_left_out(make_events):
    rows = [event(0, "boss_phase", "boss_1", None)]
    assert facts.raid_summary(make_events(*rows), "player_").count() == 0


def test_damage_received_meets_its_target(make_events):
    rows = [
        event(0, "combat_damage", "a", "dps", damage_amount=7.0, target_entity_id="b"),
        event(1, "combat_damage", "b", "tank", damage_amount=2.0, target_entity_id="a"),
        event(2, "combat_damage", "a", "dps", damage_amount=1.0, target_entity_id="b"),
    ]
    got = {r.player_id: r.total_damage_received
           for r in facts.player_raid_stats(make_events(*rows)).collect()}
    assert got == {"a": 2.0, "b": 8.0}


def test_null_raid_and_source(make_events):
    rows = [
        event(0, "spell_cast", "a", "dps"),
        {**event(4, "combat_damage", None, None), "damage_amount": 3.0},
        {**event(5, "spell_cast", "x", "dps"), "raid_id": None},
    ]
    got = facts.raid_summary(make_events(*rows)).collect()
    assert [(r.raid_id, r.n_players, r.total_damage, r.duration_ms) for r in got] == [
        ("raid001", 1, 3.0, 4000.0)]
    assert facts.player_raid_stats(make_events(*rows)).count() == 1


def test_lean_facts(make_events):
    rows = success_rows() + [event(4, "spell_cast", "boss_1", None, server_latency_ms=30)]
    raid = facts.lean_raid_fact(make_events(*rows)).first()
    assert (raid.total_events, raid.n_players, raid.n_critical_hits) == (4, 3, 1)
    assert (raid.raid_duration_s, raid.avg_server_latency_ms) == (4.0, 30.0)
    assert raid.avg_damage_per_event == 15000.0
    player = facts.lean_player_fact(make_events(*rows), "player").collect()
    assert {r.source_player_id: r.critical_hit_rate_pct for r in player} == {
        "player1": 100.0, "player2": 0.0}
    # No healing at all stays null here.
    assert {r.source_player_id: r.total_healing for r in player} == {
        "player1": None, "player2": 5000.0}


def test_dimensions(make_events):
    other = {**event(0, "spell_cast", "player1", "dps"), "raid_id": "raid002",
             "event_date": "2026-02-01", "timestamp": datetime(2026, 2, 1)}
    events = make_events(*success_rows(), other)
    players = {r.player_id: r for r in dimensions.dim_player(events, "player").collect()}
    assert players["player1"].total_raids == 2
    assert players["player1"].first_seen_date == date(2026, 1, 1)
    assert players["player1"].last_seen_date == date(2026, 2, 1)
    assert players["player1"].player_name == "Alice"
    raids = {r.raid_id: r for r in dimensions.dim_raid(events).collect()}
    assert raids["raid001"].raid_size == 2 and raids["raid001"].boss_name == "Unknown Boss"
    assert raids["raid001"].duration_target_ms == 360000.0
    nameless = make_events({**event(0, "spell_cast", "player_9", None)})
    assert dimensions.dim_player(nameless).first().player_class == "unknown"
    assert "ingested_at" in dimensions.stamped(raids_frame(events), "2026-01-01").columns


def raids_frame(events):
    return dimensions.dim_raid(events)

"""Facts against a plain loop over random events."""

from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from emberlog.operators import facts

START = datetime(2026, 1, 1)
KINDS = ["combat_damage", "heal", "player_death", "spell_cast"]

one_event = st.fixed_dictionaries({
    "raid_id": st.sampled_from(["raid001", "raid002"]),
    "event_type": st.sampled_from(KINDS),
    "at": st.integers(0, 1000),
    "source_player_id": st.sampled_from(["player_a", "player_b", "boss_1"]),
    "source_player_role": st.sampled_from(["tank", "healer", "dps", None]),
    "damage_amount": st.one_of(st.none(), st.integers(0, 500).map(float)),
    "healing_amount": st.one_of(st.none(), st.integers(0, 500).map(float)),
    "is_critical_hit": st.sampled_from([True, False, None]),
    "target_entity_type": st.sampled_from(["boss", "player"]),
    "target_entity_id": st.sampled_from(["player_a", "player_b", "boss_1"]),
    "target_entity_health_pct_after": st.one_of(st.none(), st.integers(0, 100).map(float)),
})


def expected(rows):
    out = {}
    for raid in {r["raid_id"] for r in rows}:
        everyone = [r for r in rows if r["raid_id"] == raid]
        own = [r for r in everyone if r["source_player_id"].startswith("player_")]
        if not own:
            continue
        damage = [r for r in own if r["event_type"] == "combat_damage"]
        heal = [r for r in own if r["event_type"] == "heal"]
        total_damage = sum(r["damage_amount"] or 0.0 for r in damage)
        total_healing = sum(r["healing_amount"] or 0.0 for r in heal)
        duration = (max(r["at"] for r in own) - min(r["at"] for r in own)) * 1000.0
        hp = min([r["target_entity_health_pct_after"] for r in own
                  if r["target_entity_type"] == "boss"
                  and r["target_entity_health_pct_after"] is not None], default=100.0)
        deaths = sum(r["event_type"] == "player_death" for r in everyone)
        ids = {r["source_player_id"] for r in own}
        players = {}
        for who in ids:
            mine = [r for r in own if r["source_player_id"] == who]
            hits = [r for r in mine if r["event_type"] in ("combat_damage", "heal")]
            dealt = sum(r["damage_amount"] or 0.0 for r in damage if r["source_player_id"] == who)
            players[who] = (
                dealt,
                sum(r["is_critical_hit"] is True for r in hits) / len(hits) if hits else 0.0,
                dealt / total_damage if total_damage else 0.0,
                sum(r["event_type"] == "player_death" for r in mine),
                sum(r["damage_amount"] or 0.0 for r in damage if r["target_entity_id"] == who),
            )
        outcome = (hp == 0 and duration <= 360000) or (hp < 10 and deaths <= len(ids))
        roles = tuple(
            len({r["source_player_id"] for r in own if r["source_player_role"] == role})
            for role in ("tank", "healer", "dps"))
        out[raid] = (
            total_damage, total_healing, deaths, len(ids), roles, duration, hp,
            "success" if outcome else "wipe", players)
    return out


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(one_event, min_size=1, max_size=40))
def test_against_a_loop(make_events, rows):
    events = make_events(*[
        {**r, "timestamp": START + timedelta(seconds=r["at"]), "event_date": "2026-01-01"}
        for r in rows
    ])
    totals = facts.player_totals(events)
    summary = facts.summarise_raids(totals, "player_")
    stats = facts.describe_players(
        totals, facts.received_by_target(events, "player_"), summary, "player_")
    players = {}
    for r in stats.collect():
        players.setdefault(r.raid_id, {})[r.player_id] = (
            r.damage_total, r.crit_rate, r.damage_share, r.player_deaths, r.total_damage_received)
    got = {
        r.raid_id: (
            r.total_damage, r.total_healing, r.total_player_deaths, r.n_players,
            (r.n_tanks, r.n_healers, r.n_dps), r.duration_ms, r.boss_min_hp_pct,
            r.raid_outcome, players[r.raid_id])
        for r in summary.collect()
    }
    assert got == expected(rows)

import json
from datetime import datetime

import pytest

from emberlog.operators import contract
from emberlog.plans import medallion
from emberlog.sources import bronze

AS_OF = "2026-01-02 00:00:00"
UUID = "11111111-1111-4111-8111-111111111111"
GOOD = {
    "event_id": UUID, "event_type": "combat_damage", "timestamp": "2026-01-01T10:00:00Z",
    "raid_id": "raid001", "source_player_id": "player_1", "source_player_name": "Alice",
    "damage_amount": 100.5,
}


def check(spark, *events, **options):
    """Broken rules of each event, in the order given."""
    text = json.dumps([e for e in events])
    documents = spark.createDataFrame(
        [("x/batch_one.json", 1, datetime(2026, 1, 1), text)],
        "path string, bytes bigint, modified timestamp, body string")
    typed = medallion.typed_events(documents, AS_OF)
    marked = contract.mark(typed, contract.event_rules(AS_OF, from_text=True, **options))
    return [
        {(e["rule"], e["column"]) for e in row.errors}
        for row in marked.orderBy("idx").collect()
    ]


def test_valid_events(spark):
    heal = {**GOOD, "event_type": "heal", "damage_amount": None, "healing_amount": 5}
    mana = {**GOOD, "event_type": "mana_regeneration", "damage_amount": None, "resource_type": "mana"}
    assert check(spark, GOOD, heal, mana) == [set(), set(), set()]


@pytest.mark.parametrize("change, broken", [
    ({"damage_amount": None}, ("conditional", "damage_amount")),
    ({"damage_amount": 0}, ("conditional", "damage_amount")),
    ({"timestamp": "2026-01-02T01:00:00Z"}, ("future", "timestamp")),
    ({"raid_id": "invalid_raid"}, ("pattern", "raid_id")),
    ({"surprise": 1}, ("extra", "_extra_keys")),
    ({"event_id": "not-a-uuid"}, ("pattern", "event_id")),
    ({"source_player_name": "A" * 13}, ("length", "source_player_name")),
    ({"source_player_name": "   "}, ("length", "source_player_name")),
    ({"source_player_role": "bard"}, ("domain", "source_player_role")),
    ({"source_player_level": 91}, ("range", "source_player_level")),
    ({"critical_multiplier": 0.5}, ("range", "critical_multiplier")),
    ({"target_entity_health_pct_after": 100.1}, ("range", "target_entity_health_pct_after")),
    ({"server_latency_ms": -1}, ("range", "server_latency_ms")),
    ({"damage_amount": 1_000_001}, ("range", "damage_amount")),
    ({"event_type": "heal", "healing_amount": 0}, ("conditional", "healing_amount")),
    ({"event_type": "mana_regeneration"}, ("conditional", "resource_type")),
    ({"source_player_level": "ten"}, ("type", "_uncast")),
    ({"data_quality_flags": "late"}, ("type", "_uncast")),
])
def test_broken_rules(spark, change, broken):
    assert check(spark, {**GOOD, **change}) == [{broken}]


def test_missing_fields_and_bad_time(spark):
    [errors] = check(spark, {"event_id": UUID})
    assert {c for r, c in errors if r == "required"} == {
        "event_type", "timestamp", "raid_id", "source_player_id", "source_player_name"}
    [errors] = check(spark, {**GOOD, "timestamp": "yesterday"})
    assert errors == {("required", "timestamp"), ("type", "_uncast")}


def test_trim_defaults_and_repeatable_id(spark):
    event = {k: v for k, v in GOOD.items() if k != "event_id"}
    event["source_player_name"] = "  Alice "
    documents = spark.createDataFrame(
        [("x/batch_one.json", 1, datetime(2026, 1, 1), json.dumps([event]))],
        "path string, bytes bigint, modified timestamp, body string")
    typed = medallion.typed_events(documents, AS_OF)
    row, again = typed.first(), typed.first()
    assert row.source_player_name == "Alice"
    assert (row.is_blocked, row.critical_multiplier, row.data_quality_flags) == (False, 1.0, [])
    assert row.source_system == "wow-raid-addon-v1.2"
    assert row.ingestion_timestamp == datetime(2026, 1, 2)
    assert row.event_id == again.event_id and len(row.event_id) == 36


def batches(make_events):
    def one(batch, idx, raid="raid001", damage=1.0):
        return {"event_id": f"{batch}{idx}", "event_type": "combat_damage", "raid_id": raid,
                "timestamp": datetime(2026, 1, 1), "source_player_id": "player_1",
                "source_player_name": "A", "damage_amount": damage, "batch_id": batch, "idx": idx}
    rows = [one("good", i) for i in range(3)]
    rows += [one("bad", i, damage=-1.0 if i != 2 else 1.0) for i in range(8)]
    rows += [one("mixed", 0), one("mixed", 1, raid="raid002")]
    return contract.mark(make_events(*rows), contract.event_rules(AS_OF, check_ids=False))


def test_batch_verdicts(make_events):
    marked = batches(make_events)
    got = {r.batch_id: (r.status, r.valid_count, r.invalid_count, r.reasons)
           for r in contract.batch_verdict(marked).collect()}
    assert got == {
        "good": ("accepted", 3, 0, ""),
        "bad": ("rejected", 1, 7, "invalid_events"),
        "mixed": ("rejected", 2, 0, "mixed_raids"),
    }
    too_many = contract.batch_verdict(marked, max_events=2).filter("batch_id = 'good'").first()
    assert too_many.reasons == "too_many_events"


def test_admission_by_batch_and_by_row(make_events):
    marked = batches(make_events)
    by_batch = contract.admit(marked).filter("accepted")
    assert {r.batch_id for r in by_batch.select("batch_id").collect()} == {"good"}
    assert contract.admit(marked, "row").filter("accepted").count() == 6
    with pytest.raises(ValueError):
        contract.admit(marked, "sometimes")


def test_first_five_errors(make_events):
    got = contract.first_errors(batches(make_events)).collect()
    assert [(r.idx, r.error_rank) for r in sorted(got, key=lambda r: r.idx)] == [
        (0, 1), (1, 2), (3, 3), (4, 4), (5, 5)]
    assert got[0].broken_rules == "range:damage_amount,conditional:damage_amount"


def test_error_limit_is_applied_before_the_shuffle(make_events):
    plan = contract.first_errors(batches(make_events))._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_batch_shapes(spark, tmp_path):
    texts = {
        "batch_env.json": json.dumps({"batch_id": "zz", "events": [GOOD, GOOD]}, indent=2),
        "batch_arr.json": json.dumps([GOOD]),
        "single.json": json.dumps(GOOD),
        "batch_none.json": "[]",
        "batch_noev.json": '{"events": []}',
        "batch_null.json": '{"events": null}',
        "batch_cut.json": '[{"event_id":"x"},{"ev',
        "batch_cut2.json": '{"events":[{"event_id":"x"}',
        "batch_odd.json": '{"events": 5}',
        "batch_num.json": "42",
    }
    for name, text in texts.items():
        (tmp_path / name).write_text(text)
    documents = bronze.read_documents(spark, str(tmp_path))
    got = {r.path.rsplit("/", 1)[1]: (r.shape, r.event_count, r.status)
           for r in bronze.batch_report(documents).collect()}
    assert got == {
        "batch_env.json": ("envelope", 2, "ok"), "batch_arr.json": ("array", 1, "ok"),
        "single.json": ("single", 1, "ok"), "batch_none.json": ("array", 0, "empty"),
        "batch_noev.json": ("envelope", 0, "empty"), "batch_null.json": ("envelope", 0, "empty"),
        "batch_cut.json": ("malformed", 0, "malformed"),
        "batch_cut2.json": ("malformed", 0, "malformed"),
        "batch_odd.json": ("malformed", 0, "malformed"),
        "batch_num.json": ("malformed", 0, "malformed"),
    }
    events = bronze.events_of(documents)
    assert events.count() == 4
    ids = {r.batch_id for r in events.select("batch_id").collect()}
    # The file name decides; a file without a batch name gets part of a hash.
    assert {"env", "arr"} <= ids and len(ids) == 3


def test_gold_contracts(spark, make_events):
    frame = spark.createDataFrame(
        [("player_1", "Alice", "mage", "DPS", datetime(2026, 1, 1).date(),
          datetime(2026, 1, 1).date(), 1),
         ("player_2", "NameThatIsTooLong", "mage", "bard", datetime(2026, 1, 1).date(),
          datetime(2026, 1, 1).date(), 0)],
        "player_id string, player_name string, player_class string, player_role string, "
        "first_seen_date date, last_seen_date date, total_raids bigint")
    with pytest.raises(contract.ContractError) as caught:
        contract.enforce(frame, "dim_player")
    assert caught.value.broken == {"dim_player": {
        ("length", "player_name"): 1, ("domain", "player_role"): 1, ("range", "total_raids"): 1}}
    good = contract.enforce(frame.filter("player_id = 'player_1'"), "dim_player").first()
    assert good.player_role == "dps"
    raids = spark.createDataFrame(
        [("raid001", datetime(2026, 1, 1).date(), None, None, 5, 1.0)],
        "raid_id string, event_date date, boss_name string, difficulty string, "
        "raid_size bigint, duration_target_ms double")
    assert contract.enforce(raids, "dim_raid").first().difficulty == "Normal"


def test_no_python_in_the_contract_plan(make_events):
    plan = batches(make_events)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan

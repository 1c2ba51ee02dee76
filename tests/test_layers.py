"""Files and whole jobs."""

import json
import re
from datetime import date, datetime, timedelta

import pytest

from emberlog.operators import contract, quality, refine
from emberlog.plans import gold as gold_plan
from emberlog.plans import medallion
from emberlog.schemas import EVENT_COLUMNS, SILVER_SCHEMA
from emberlog.sources import bronze, files, gold, silver
from emberlog.sources.sample_events import with_redelivery
from pyspark.sql import functions as F

AS_OF = "2024-02-01 00:00:00"


def rows_of(frame):
    return sorted(map(str, frame.collect()))


def test_envelopes_are_bounded_and_ordered(make_events, tmp_path, spark):
    rows = [{"event_id": f"e{i}", "raid_id": "raid001", "batch_id": "b", "idx": i % 7,
             "timestamp": datetime(2026, 1, 1)} for i in range(50)]
    packed = bronze.envelopes(make_events(*rows).coalesce(1), max_events=4)
    sizes = [r.event_count for r in packed.collect()]
    assert sum(sizes) == 50 and max(sizes) <= 4
    whole = bronze.envelopes(make_events(*[{**r, "idx": 49 - i} for i, r in enumerate(rows)]).coalesce(1))
    ids = [e.event_id for e in whole.first().events]
    assert ids == [f"e{i}" for i in range(49, -1, -1)]


def test_a_batch_of_two_raids_lands_in_two_folders(make_events, tmp_path, spark):
    events = make_events(
        {"event_id": "a", "raid_id": "raid001", "batch_id": "b", "idx": 0, "timestamp": datetime(2026, 1, 1)},
        {"event_id": "b", "raid_id": "raid002", "batch_id": "b", "idx": 1, "timestamp": datetime(2026, 1, 1)})
    bronze.write_envelopes(bronze.envelopes(events), str(tmp_path))
    assert {p.name for p in tmp_path.iterdir() if p.is_dir()} == {"raid_id=raid001", "raid_id=raid002"}


def test_a_repeated_load_replaces_itself(sample, tmp_path, spark):
    packed = bronze.envelopes(sample, stamp=F.col("ingestion_timestamp"))
    for _ in range(2):
        bronze.write_envelopes(packed, str(tmp_path / "b"), load="one")
    bronze.write_envelopes(packed, str(tmp_path / "b"), load="two")
    assert bronze.read_events(spark, str(tmp_path / "b"), "lines").count() == 2 * sample.count()


def test_landing_keeps_unknown_fields_and_times(spark, tmp_path):
    source = tmp_path / "raid007"
    source.mkdir()
    (source / "batch_x.json").write_text(json.dumps(
        {"batch_id": "x", "events": [{"event_id": "e", "odd": 'a "quoted"\nline', "n": [1, 2]}]}, indent=2))
    (source / "batch_bad.json").write_text("{")
    documents = bronze.read_documents(spark, str(tmp_path))
    plan = {r.batch_id: (r.status, r.target_key) for r in bronze.landing_plan(documents, "2026-01-05").collect()}
    assert plan["x"] == ("ok", "raid_id=raid007/ingest_date=2026-01-05/batch_x.json")
    assert plan["bad"][0] == "malformed"
    assert bronze.land_documents(documents, str(tmp_path / "out"), "2026-01-05") == 1
    event = bronze.read_events(spark, str(tmp_path / "out"), "lines").first()
    assert (event.event_id, event.raid_id, event.batch_id) == ("e", "raid007", "x")
    assert sorted(event._extra_keys) == ["n", "odd"]


def test_old_folder_style_and_inventory(spark, tmp_path):
    for folder in ("raidid=raid001/ingest_date=2026-01-01", "raid_id=raid002/ingest_date=2026-01-02"):
        (tmp_path / folder).mkdir(parents=True)
        (tmp_path / folder / "batch_a.json").write_text('[{"event_id": "e"}]')
    events = bronze.read_events(spark, str(tmp_path))
    assert {r.raid_id for r in events.collect()} == {"raid001", "raid002"}
    listed = files.inventory(spark, str(tmp_path), "*.json")
    assert {(r.style, r.raid_id, r.files) for r in files.prefix_audit(listed).collect()} == {
        ("raidid", "raid001", 1), ("raid_id", "raid002", 1)}
    assert files.layer_size(listed).count() == 2
    assert files.latest_file(listed).first().path.endswith("batch_a.json")


def test_silver_partitions(make_events, spark, tmp_path):
    path = str(tmp_path / "s")
    before = datetime(2026, 1, 1, 23, 59, 59)
    events = refine.enrich(make_events(*[
        {"event_id": f"e{i}", "raid_id": "raid001", "timestamp": before + timedelta(seconds=i)}
        for i in range(3)
    ]))
    assert silver.write_silver(events, path)["rows"] == 3
    found = [(r.raid_id, r.event_date) for r in silver.silver_partitions(spark, path).collect()]
    assert found == [("raid001", date(2026, 1, 1)), ("raid001", date(2026, 1, 2))]
    # Writing one date again leaves the other alone.
    silver.write_silver(events.filter("event_date = '2026-01-02'").limit(1), path)
    assert silver.read_silver(spark, path).count() == 2
    assert silver.write_silver(events.filter("false"), path)["status"] == "skipped"
    assert silver.read_silver_partition(spark, path, "raid001", "2026-01-01").count() == 1
    with pytest.raises(ValueError):
        silver.read_silver_partition(spark, path, "raid001", "2030-01-01")
    plan = silver.read_silver(spark, path).filter("raid_id = 'raid001'").select("event_id")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(raid_id" in text and "damage_amount" not in text


def test_unreadable_partition(spark, tmp_path, make_events):
    path = tmp_path / "s"
    events = refine.enrich(make_events({"event_id": "e", "raid_id": "raid001", "timestamp": datetime(2026, 1, 1)}))
    silver.write_silver(events, str(path))
    folder = path / "raid_id=raid001" / "event_date=2026-01-01"
    (folder / "broken.parquet").write_text("not parquet")
    assert silver.read_silver_partition(spark, str(path), "raid001", "2026-01-01").count() == 1
    other = path / "raid_id=raid002" / "event_date=2026-01-01"
    other.mkdir(parents=True)
    (other / "broken.parquet").write_text("not parquet")
    with pytest.raises(RuntimeError):
        silver.read_silver_partition(spark, str(path), "raid002", "2026-01-01")


@pytest.fixture(scope="module")
def layers(spark, sample, tmp_path_factory):
    root = tmp_path_factory.mktemp("layers")
    made = medallion.Layers(*[str(root / n) for n in ("bronze", "silver", "gold", "rejects")])
    twice = with_redelivery(sample)
    bronze.write_envelopes(bronze.envelopes(twice, stamp=F.col("ingestion_timestamp")), made.bronze)
    steps = medallion.run_medallion(spark, made, as_of=AS_OF, player_prefix="player_")
    return made, {(r.stage, r.table): r.rows for r in steps.collect()}


def test_chain(spark, sample, layers):
    made, rows = layers
    expected = refine.in_range(sample)
    assert rows[("silver", "events")] == expected.count()
    assert rows[("gold", "rejects")] == 0
    summary = gold.read_gold(spark, made.gold, "fact_raid_summary")
    assert summary.count() == expected.select("raid_id").distinct().count()
    checks = spark.read.parquet(f"{made.gold}/coherence")
    assert checks.filter("status = 'fail'").isEmpty()
    assert {r.status for r in quality.verdict(checks).collect()} <= {"ok", "warn"}


def test_chain_again_changes_nothing(spark, layers):
    made, _ = layers
    before = {n: rows_of(gold.read_gold(spark, made.gold, n)) for n in gold_plan.GoldTables._fields}
    medallion.run_medallion(spark, made, as_of=AS_OF, player_prefix="player_")
    after = {n: rows_of(gold.read_gold(spark, made.gold, n)) for n in gold_plan.GoldTables._fields}
    assert before == after


def test_one_batch_adds_nothing_that_is_there(spark, layers):
    made, _ = layers
    batch = bronze.read_events(spark, made.bronze, "lines").first().batch_id
    assert medallion.run_silver(spark, made, batch_id=batch, as_of=AS_OF)["rows"] == 0


def test_partition_by_partition_equals_all_at_once(spark, layers, tmp_path):
    made, _ = layers
    out = str(tmp_path / "gold")
    some = silver.silver_partitions(spark, made.silver).limit(3).collect()
    for part in [*some, some[0]]:
        gold_plan.run_gold_partition(
            spark, made.silver, out, part.raid_id, str(part.event_date), player_prefix="player_")
    wanted = [r.raid_id for r in some]
    whole = silver.read_silver(spark, made.silver).filter(F.col("raid_id").isin(wanted))
    tables = gold_plan.gold_tables(whole, "player_")
    for name in gold_plan.GoldTables._fields:
        assert rows_of(gold.read_gold(spark, out, name)) == rows_of(
            contract.conform(getattr(tables, name), name).select(
                *gold.read_gold(spark, out, name).columns)), name
    part = gold.read_gold_part(spark, out, "fact_raid_summary", raid_id=wanted[0])
    assert part.first().raid_id == wanted[0]


def test_facts_by_date_only(spark, sample, tmp_path):
    tables = gold_plan.gold_tables(sample, "player_")
    gold_plan.publish(tables, str(tmp_path), fact_partitions=("event_date",))
    expected = rows_of(tables.fact_raid_summary)
    facts_path = tmp_path / "fact_raid_summary"
    assert all(p.name.startswith("event_date=") for p in facts_path.iterdir() if p.is_dir())
    assert rows_of(gold.read_gold(spark, str(tmp_path), "fact_raid_summary").select(
        *tables.fact_raid_summary.columns)) == expected


def test_contract_stops_publication_or_sorts_out(spark, make_events, tmp_path):
    rows = [{"event_id": f"e{i}", "raid_id": f"raid{i:03d}" if i else "bad raid",
             "timestamp": datetime(2026, 1, 1), "event_date": "2026-01-01", "event_type": "spell_cast",
             "source_player_id": "player_1", "source_player_name": "A"} for i in range(3)]
    tables = gold_plan.gold_tables(make_events(*rows))
    with pytest.raises(contract.ContractError):
        gold_plan.publish(tables, str(tmp_path / "strict"))
    assert not (tmp_path / "strict").exists()
    gold_plan.publish(tables, str(tmp_path / "lenient"), "reject")
    status = {r.raid_id: r.status for r in gold_plan.raid_status(tables).collect()}
    assert status == {"bad raid": "failed", "raid001": "ok", "raid002": "ok"}
    kept = gold.read_gold(spark, str(tmp_path / "lenient"), "fact_raid_summary")
    assert {r.raid_id for r in kept.collect()} == {"raid001", "raid002"}
    rejects = spark.read.parquet(str(tmp_path / "lenient" / "rejects"))
    assert rejects.filter("`table` = 'fact_raid_summary'").count() == 1


def test_layer_comparison(spark, layers):
    made, _ = layers
    raw = bronze.read_events(spark, made.bronze, "lines")
    refined = silver.read_silver(spark, made.silver)
    changes = {r.column: r.change for r in quality.schema_changes(raw, refined).collect()}
    assert changes["is_massive_hit"] == "added" and changes["damage_amount"] == "retyped"
    assert changes["path"] == "removed" and "event_type" not in changes
    checks = {r.check_id: r.status for r in quality.check_columns(refined, ["event_id", "nope"]).collect()}
    assert checks == {"columns": "fail", "has_rows": "ok"}
    assert silver.preview(refined).count() == 3
    sizes = quality.size_change(
        files.inventory(spark, made.bronze, "*.json"), files.inventory(spark, made.silver, "*.parquet")
    ).first()
    assert sizes.files_before > 0 and sizes.files_after > 0
    assert abs(sizes.reduction_pct - (1 - sizes.bytes_after / sizes.bytes_before) * 100) < 1e-9
    assert refined.schema.names == SILVER_SCHEMA.names


def test_run_record(spark, tmp_path):
    bronze.append_run(spark, str(tmp_path / "runs"), "run_1", "2026-01-01 00:00:00",
                      "2026-01-01 00:00:04", "files", 100, num_raids=2)
    bronze.append_run(spark, str(tmp_path / "runs"), "run_2", "2026-01-01 00:00:00",
                      "2026-01-01 00:00:00", "files", 100, num_raids=2)
    got = {r.run_id: r.asDict().get("events_per_second")
           for r in spark.read.json(str(tmp_path / "runs")).collect()}
    assert got == {"run_1": 25.0, "run_2": None}


def test_facts_scan_only_what_they_need(spark, layers):
    made, _ = layers
    from emberlog.operators import facts
    summary = facts.raid_summary(silver.read_silver(spark, made.silver), "player_")
    text = summary._jdf.queryExecution().executedPlan().toString()
    assert "ability_name" not in text and "Python" not in text and "Window" not in text
    assert "partial_" in text


EVENT = '{"event_id":"a","raid_id":"raid001","damage_amount":1.50,"data_quality_flags":["x", null],"zone":{"k":[1, 2]}}'


def envelope(*events):
    return '{"batch_id":"b1","ingest_timestamp":"t","events":[' + ", ".join(events) + "]}"


ODD_DOCUMENTS = [
    envelope(EVENT, EVENT), envelope(), envelope("null", EVENT), envelope("5", EVENT), envelope('"x"'), envelope('""', EVENT),
    envelope("[" + EVENT + "]"), envelope(EVENT) + " tail", envelope(EVENT)[:-2], "  " + envelope(EVENT),
    "　" + envelope(EVENT), "[" + EVENT + "]", '[{"events":[' + EVENT + "]}]", EVENT, "[]", "", "x", None,
    '{"events":3}', '{"events":null}', '{"batch_id":5,"events":[' + EVENT + "]}", '{"events":[1],"events":[' + EVENT + "]}",
    '{"events":[' + EVENT + '],"events":5}', envelope('{"damage_amount":NaN,"event_id":Infinity}', EVENT),
    envelope('{"healing_amount":-INF,"event_id":"NaN"}'), '{"events":[{"event_id":"a"}],"_unread":{"a":1}}',
]


def test_plain_events_are_those_of_the_texts(spark):
    places = ("/x/raid_id=raid002/f{}.json", "/x/batch_n{}.json")
    rows = [(places[i % 2].format(i), None, None, body) for i, body in enumerate(ODD_DOCUMENTS)]
    documents = spark.createDataFrame(rows, bronze.DOCUMENT_SCHEMA)
    columns = [*EVENT_COLUMNS, "path", "batch_id", "idx"]
    assert rows_of(bronze.plain_events(documents).select(*columns)) == rows_of(bronze.events_of(documents).select(*columns))
    # One parsing of a document that fits, and none of its single events.
    plan = medallion.silver_input(documents, AS_OF)._jdf.queryExecution().optimizedPlan().toString()
    generate = next(line for line in plan.splitlines() if "Generate posexplode" in line)
    assert "from_json" not in plan[:plan.index(generate)].replace("from_json(ArrayType(StringType,true)", "")
    assert plan.count("_unread,StringType") == 1
    # No event carries a copy of its document, and no filter repeats the parsing.
    physical = medallion.silver_input(documents, AS_OF)._jdf.queryExecution().executedPlan().toString()
    carried = re.search(r"END\), \[([^]]*)\], false", physical).group(1)
    assert not {"_whole", "_extract_events", "items", "body"} & set(re.findall(r"(\w+)#", carried))
    assert "Filter" not in plan

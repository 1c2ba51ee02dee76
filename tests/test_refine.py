from datetime import date, datetime, timedelta

from emberlog.operators import refine
from pyspark.sql import functions as F

T0 = datetime(2026, 1, 1, 23, 59, 59)


def row(event_id, **more):
    return {"event_id": event_id, "event_type": "spell_cast", "timestamp": T0,
            "raid_id": "raid001", **more}


def test_duplicates_inside_and_across_batches(make_events):
    events = make_events(
        row("a", batch_id="b2", idx=0, ingestion_timestamp=T0 + timedelta(hours=2), ability_id="late"),
        row("a", batch_id="b1", idx=1, ingestion_timestamp=T0 + timedelta(hours=1), ability_id="second"),
        row("a", batch_id="b1", idx=0, ingestion_timestamp=T0 + timedelta(hours=1), ability_id="first"),
        row("b", batch_id="b1", idx=2, ingestion_timestamp=T0),
        row(None, batch_id="b1", idx=3), row(None, batch_id="b1", idx=4),
    )
    got = {r.event_id: r.ability_id for r in refine.deduplicate(events).collect()}
    assert got == {"a": "first", "b": None, None: None}
    assert refine.deduplicate(events).columns == events.columns


def test_dominant_duplicate_is_reduced_before_the_shuffle(spark):
    """A third of all rows being one event must not reach one task."""
    frame = spark.range(0, 30000, 1, 4).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("event_id"),
        F.col("id").alias("idx"), F.lit("b").alias("batch_id"), F.lit(T0).alias("ingestion_timestamp"))
    result = refine.deduplicate(frame)
    assert result.count() == 20001
    assert result.filter("event_id = 'hot'").first().idx == 0
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and "Window" not in plan


def test_range_filter_keeps_null_and_counts_once(make_events):
    before, after = refine.HEALTH_COLUMNS
    events = make_events(
        row("ok", **{before: 0.0, after: 100.0}), row("null"),
        row("both", **{before: -1.0, after: 101.0}), row("after", **{before: 5.0, after: 100.5}),
    )
    assert {r.event_id for r in refine.in_range(events).collect()} == {"ok", "null"}
    counts = events.agg(*refine.range_errors()).first()
    assert (counts[f"bad_{before}"], counts[f"bad_{after}"]) == (1, 1)
    bounded = refine.in_bounds(events, [(before, 1, None)])
    assert {r.event_id for r in bounded.collect()} == {"null", "after"}


def test_enrichment(make_events):
    events = make_events(
        row("a", event_type="combat_damage", damage_amount=10001.0,
            ingestion_timestamp=T0 + timedelta(microseconds=1999)),
        row("b", event_type="combat_damage", damage_amount=10000.0,
            ingestion_timestamp=T0 - timedelta(microseconds=1999)),
        row("c", event_type="heal", damage_amount=99999.0),
    )
    got = {r.event_id: (r.is_massive_hit, r.ingest_latency_ms, r.event_date)
           for r in refine.enrich(events).collect()}
    day = date(2026, 1, 1)
    assert got == {"a": (True, 1, day), "b": (False, -1, day), "c": (False, 0, day)}
    bare = refine.enrich(events.select("event_id", "timestamp")).first()
    assert bare.is_massive_hit is False
    assert refine.enrich(events, massive_hit=5).filter("is_massive_hit").count() == 2


def test_casts(spark):
    raw = spark.createDataFrame(
        [("1.5", "70.0", "true", '["a",null,3]', "2026-01-01T00:00:00Z"),
         ("junk", "70.5", "maybe", "late", "junk"), ("NaN", "71", "false", None, None)],
        "damage_amount string, source_player_level string, is_blocked string, "
        "data_quality_flags string, timestamp string")
    got = refine.cast_types(raw).collect()
    assert [r.damage_amount for r in got] == [1.5, None, None]
    assert [r.source_player_level for r in got] == [70, None, 71]
    assert [r.is_blocked for r in got] == [True, None, False]
    assert [r.data_quality_flags for r in got] == [["a", "3"], [], []]
    assert [r.timestamp for r in got] == [datetime(2026, 1, 1), None, None]
    drifted = spark.createDataFrame([(70.0,)], "source_player_level double")
    assert refine.cast_types(drifted).first().source_player_level == 70


def test_whole_refinement_with_counters(make_events, tmp_path):
    before = refine.HEALTH_COLUMNS[0]
    events = make_events(
        row("a"), row("a", ingestion_timestamp=T0), row("b", **{before: 200.0}), row("c"))
    refined, seen, unique = refine.refine_observed(events)
    refined.write.parquet(str(tmp_path / "out"))
    metrics = refine.refine_metrics(seen, unique)
    assert metrics["rows_in"] == 4 and metrics["duplicates_removed"] == 1
    assert metrics[f"bad_{before}"] == 1 and metrics["rows_after_validation"] == 2
    report = refine.refine_report(events).first()
    assert (report.rows_in, report.duplicates_removed, report.rows_after_validation) == (4, 1, 2)
    silver = refine.as_silver(refined)
    assert [f.dataType for f in silver.schema] == [f.dataType for f in refine.SILVER_SCHEMA]
    assert refine.not_yet_in(events, refined.filter("event_id = 'a'")).count() == 2


def test_one_shuffle(make_events):
    plan = refine.refine(make_events(row("a")))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Python" not in plan


def test_feed_and_legacy_names(make_events):
    events = make_events(
        row("a", damage_amount=0.0, healing_amount=4.0), row("b", damage_amount=3.0), row("c"))
    assert sorted(str(r.amount) for r in refine.live_feed(events).collect()) == ["3.0", "4.0", "None"]
    assert "raidid" in refine.legacy_names(events).columns

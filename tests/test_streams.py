import json
from datetime import datetime

import pytest

from emberlog import constants as C
from emberlog.operators import refine
from emberlog.plans import medallion, registry
from emberlog.sources import bronze, id_index, silver
from emberlog.sources.sample_events import with_redelivery
from emberlog.streaming import delivery, feed, ingest, metrics
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

AS_OF = "2024-02-01 00:00:00"


def rows_of(frame):
    return sorted(map(str, frame.collect()))


@pytest.fixture(scope="module")
def stored(spark, sample, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("stored") / "bronze")
    twice = with_redelivery(sample)
    bronze.write_envelopes(bronze.envelopes(twice, stamp=F.col("ingestion_timestamp")), path)
    return path


def test_refine_stream_in_one_and_in_many_batches(spark, sample, stored, tmp_path):
    results = []
    for n in (None, 7):
        root = tmp_path / str(n)
        query = ingest.refine_stream(
            spark, stored, str(root / "s"), str(root / "c"), max_files=n, as_of=AS_OF)
        query.awaitTermination()
        results.append(rows_of(silver.read_silver(spark, str(root / "s")).select(
            "event_id", "raid_id", "event_date", "damage_amount")))
        batches = metrics.progress_table(spark, query)
        assert batches.agg(F.sum("rows")).first()[0] > 0
        if n:
            assert batches.count() > 1
    batch = refine.enrich(refine.in_range(sample)).select(
        "event_id", "raid_id", "event_date", "damage_amount")
    assert results[0] == results[1] == rows_of(batch)


def test_refine_stream_restarts_without_repeating(spark, sample, stored, tmp_path):
    for checkpoint in ("c1", "c1", "c2"):
        # A lost checkpoint reads everything again; the rows are there already.
        ingest.refine_stream(
            spark, stored, str(tmp_path / "s"), str(tmp_path / checkpoint), as_of=AS_OF
        ).awaitTermination()
    out = silver.read_silver(spark, str(tmp_path / "s"))
    assert out.count() == out.select("event_id").distinct().count() == refine.in_range(sample).count()


def test_watermarked_variant(spark, sample, stored, tmp_path):
    ingest.refine_stream_within(
        spark, stored, str(tmp_path / "s"), str(tmp_path / "c"), "40 days", as_of=AS_OF
    ).awaitTermination()
    out = silver.read_silver(spark, str(tmp_path / "s"))
    assert out.select("event_id").distinct().count() == out.count() == refine.in_range(sample).count()


def event(i, **more):
    return {"event_id": f"11111111-1111-4111-8111-{i:012d}", "event_type": "heal",
            "timestamp": "2024-01-01T00:00:00Z", "raid_id": "raid001",
            "source_player_id": "player_1", "source_player_name": "A", "healing_amount": 2.0, **more}


def test_ingest_stream(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "batch_good.json").write_text(json.dumps([event(1), event(2)]))
    (landing / "batch_bad.json").write_text(json.dumps([event(3), {"event_id": "only"}]))
    (landing / "batch_empty.json").write_text("[]")
    (landing / "batch_text.json").write_text("not json")
    (landing / "batch_mixed.json").write_text(json.dumps([event(4), event(5, raid_id="raid002")]))
    args = (spark, str(landing), str(tmp_path / "b"), str(tmp_path / "r"), str(tmp_path / "c"))
    ingest.ingest_stream(*args, max_files=2, as_of=AS_OF).awaitTermination()
    events = bronze.read_events(spark, str(tmp_path / "b"), "lines")
    assert {(r.event_id[-1], r.batch_id) for r in events.collect()} == {("1", "good"), ("2", "good")}
    refused = spark.read.parquet(str(tmp_path / "r")).collect()
    reasons = {(r.batch_id, r.idx, r.reasons) for r in refused}
    assert ("empty", None, "empty") in reasons and ("text", None, "malformed") in reasons
    whole = {(r.batch_id, r.idx): r.batch_reasons for r in refused}
    assert whole[("mixed", 0)] == whole[("mixed", 1)] == "mixed_raids"
    assert whole[("bad", 0)] == whole[("bad", 1)] == "invalid_events"
    assert any(b == "bad" and i == 1 and r.startswith("required:event_type") for b, i, r in reasons)
    # The event itself is kept.
    assert json.loads(next(r.event for r in refused if (r.batch_id, r.idx) == ("bad", 0))) == event(3)
    # A later file is picked up alone.
    (landing / "batch_later.json").write_text(json.dumps([event(6)]))
    ingest.ingest_stream(*args, max_files=2, as_of=AS_OF).awaitTermination()
    assert bronze.read_events(spark, str(tmp_path / "b"), "lines").count() == 3


def test_every_refused_event_is_kept(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "batch_many.json").write_text(json.dumps([{"event_id": f"e{i}"} for i in range(8)] + [event(1)]))
    for mode, accepted in (("row", 1), ("batch", 0)):
        root = tmp_path / mode
        ingest.ingest_stream(spark, str(landing), str(root / "b"), str(root / "r"), str(root / "c"), as_of=AS_OF,
                             mode=mode).awaitTermination()
        refused = spark.read.parquet(str(root / "r"))
        assert refused.count() == 9 - accepted
        assert refused.filter("event is null or idx is null").isEmpty()


def test_verdict_does_not_depend_on_micro_batches(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "one.json").write_text(json.dumps({"batch_id": "x", "events": [event(1)]}))
    (landing / "two.json").write_text(json.dumps({"batch_id": "x", "events": [event(2), {"event_id": "e"}]}))
    found = []
    for n in (1, None):
        root = tmp_path / str(n)
        ingest.ingest_stream(spark, str(landing), str(root / "b"), str(root / "r"), str(root / "c"), max_files=n,
                             as_of=AS_OF).awaitTermination()
        found.append(sorted(r.event_id for r in bronze.read_events(spark, str(root / "b"), "lines").collect()))
    assert found[0] == found[1] and len(found[0]) == 1


def test_rows_without_a_partition(spark, tmp_path):
    raw = [{**event(1), "timestamp": "never"}, event(2)]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text(json.dumps(raw))
    documents = bronze.read_documents(spark, str(tmp_path / "in"))
    for _ in range(2):
        ingest.refine_batch(documents, str(tmp_path / "s"), AS_OF)
        ingest.refine_batch(documents, str(tmp_path / "s2"), AS_OF, str(tmp_path / "r"), "load-1")
    assert silver.read_silver(spark, str(tmp_path / "s")).count() == 2
    assert silver.read_silver(spark, str(tmp_path / "s2")).count() == 1
    assert spark.read.parquet(str(tmp_path / "r")).count() == 1


def test_ingest_retry_replaces_its_own_output(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "batch_good.json").write_text(json.dumps([event(1), event(2)]))
    documents = bronze.read_documents(spark, str(landing))
    for _ in range(2):
        ingest.ingest_batch(documents, "x-1", str(tmp_path / "b"), str(tmp_path / "r"), as_of=AS_OF)
    assert bronze.read_events(spark, str(tmp_path / "b"), "lines").count() == 2


def test_repeats_under_another_date_are_found(spark, tmp_path):
    for n, day in enumerate(("01", "02", "03")):
        (tmp_path / "in").mkdir(exist_ok=True)
        again = [event(i, timestamp=f"2024-01-{day}T00:00:00Z", raid_id=f"raid00{n + 1}") for i in (1, 2, 10 + n)]
        (tmp_path / "in" / f"{n}.json").write_text(json.dumps(again))
        ingest.refine_stream(spark, str(tmp_path / "in"), str(tmp_path / "s"), str(tmp_path / f"c{n % 2}"),
                             layout="document", as_of=AS_OF).awaitTermination()
    rows = silver.read_silver(spark, str(tmp_path / "s")).collect()
    assert sorted((r.event_id[-2:], str(r.event_date)) for r in rows) == [
        ("01", "2024-01-01"), ("02", "2024-01-01"), ("10", "2024-01-01"), ("11", "2024-01-02"), ("12", "2024-01-03")]


def test_refinement_recovers_between_index_and_rows(spark, tmp_path, monkeypatch):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text(json.dumps([event(1), event(2)]))
    documents = bronze.read_documents(spark, str(tmp_path / "in"))
    with monkeypatch.context() as broken:
        broken.setattr(ingest, "write_table", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            ingest.refine_batch(documents, str(tmp_path / "s"), AS_OF, load="x-1")
    assert ingest.refine_batch(documents, str(tmp_path / "s"), AS_OF, load="x-1") == 2
    assert ingest.refine_batch(documents, str(tmp_path / "s"), AS_OF, load="x-1") == 0
    assert ingest.refine_batch(documents, str(tmp_path / "s"), AS_OF, load="x-2") == 0
    assert silver.read_silver(spark, str(tmp_path / "s")).count() == 2


def test_index_reads_the_buckets_of_its_ids_only(spark, sample, tmp_path):
    index = str(tmp_path / "ids")
    id_index.add_ids(sample, index, "a")
    some = sample.limit(1)
    held = id_index.held_ids(spark, index, some)
    files = held.select(F.input_file_name()).distinct().count()
    assert files == 1 and held.join(some, "event_id", "left_semi").count() == 1
    plan = held._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan or "PartitionFilters: [bucket" in plan


def test_files_are_judged_by_size_before_they_are_read(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "batch_void.json").write_text("")
    (landing / "batch_huge.json").write_text(json.dumps([event(1)]) + " " * 5000)
    (landing / "batch_good.json").write_text(json.dumps([event(2)]))
    (landing / "batch_text.json").write_text("not json")
    args = (spark, str(landing), str(tmp_path / "b"), str(tmp_path / "r"), str(tmp_path / "c"))
    ingest.ingest_stream(*args, as_of=AS_OF, max_bytes=4000, counters=str(tmp_path / "n")).awaitTermination()
    refused = {(r.batch_id, r.reasons, r.event) for r in spark.read.parquet(str(tmp_path / "r")).collect()}
    assert refused == {("void", "empty", None), ("huge", "too_large", None), ("text", "malformed", "not json")}
    counters = metrics.read_counters(spark, str(tmp_path / "n")).collect()
    assert [(r.events, r.accepted, r.refused) for r in counters] == [(1, 1, 0)]


def test_a_micro_batch_of_unusable_files_only(spark, tmp_path):
    (tmp_path / "landing").mkdir()
    (tmp_path / "landing" / "batch_void.json").write_text("")
    ingest.ingest_stream(spark, str(tmp_path / "landing"), str(tmp_path / "b"), str(tmp_path / "r"), str(tmp_path / "c"),
                         as_of=AS_OF).awaitTermination()
    assert [r.reasons for r in spark.read.parquet(str(tmp_path / "r")).collect()] == ["empty"]


def test_two_consumers_have_their_own_position(spark, sample, stored, tmp_path):
    stream = feed.feed(spark, stored, max_files=15)
    counts = {"one": 0, "two": 0}

    def consumer(name):
        def consume(batch, epoch):
            counts[name] += batch.count()
        return consume

    for name in counts:
        feed.subscribe(stream, consumer(name), str(tmp_path / name), name).awaitTermination()
    assert counts == {"one": 2 * sample.count(), "two": 2 * sample.count()}


def test_replay_plan(spark, sample, tmp_path):
    path = str(tmp_path / "replay")
    bronze.write_replay(bronze.replay_chunks(sample, 10, "tests"), path)
    plan = feed.replay_plan(spark, path).orderBy("raid_id", "position").collect()
    assert all(r.batch_id == f"{r.raid_id}_batch_{r.position:04d}" for r in plan)
    assert feed.replay_plan(spark, path, max_batches=4).count() == 4
    sent = []
    assert feed.replay_batches(spark, path, lambda df: sent.append(df.select("position").distinct().collect()), step=1) == len(plan)
    assert [{r.position for r in step} for step in sent] == [{i + 1} for i in range(max(r.position for r in plan))]
    steps, n = feed.replay_steps(spark, path, step=2)
    one = steps.filter(F.col("step") == n - 1)
    assert all(f"step={n - 1}/" in r[0] for r in one.select(F.input_file_name()).distinct().collect())
    assert "PartitionFilters: [isnotnull(step" in one._jdf.queryExecution().executedPlan().toString()
    sizes = bronze.batch_report(bronze.read_documents(spark, path, "lines"))
    assert sizes.filter("event_count > 10").isEmpty()
    assert sizes.agg(F.sum("event_count")).first()[0] == sample.count()


def test_delivery_attempts():
    calls = []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise PySparkException("io")
        return 7

    assert delivery.deliver(flaky, 3, wait=0) == 7
    calls.clear()
    with pytest.raises(PySparkException):
        delivery.deliver(flaky, 2, wait=0)


def test_listener_records(spark, stored, tmp_path):
    listener = metrics.MetricsListener(spark, str(tmp_path / "m"))
    spark.streams.addListener(listener)
    try:
        feed.subscribe(
            feed.feed(spark, stored), lambda b, e: b.count(), str(tmp_path / "c"), "listened"
        ).awaitTermination()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(listener)
    rows = spark.read.json(str(tmp_path / "m")).collect()
    assert [r.name for r in rows] == ["listened"] and rows[0].rows > 0


def test_documents_are_parsed_once(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "batch_good.json").write_text(" \n" + json.dumps([event(1), event(2)]) + "\t")
    (landing / "batch_none.json").write_text(" 　\n")
    (landing / "batch_text.json").write_text(" not json\n")
    rows = medallion.marked_rows(bronze.read_documents(spark, str(landing)), AS_OF)
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(StructField(batch_id") == 1
    # No event carries a copy of its document.
    generate = next(line for line in plan.splitlines() if "Generate posexplode" in line)
    below = plan[plan.index(generate):].splitlines()[1]
    assert "isnotnull(_unusable" in below and "AS _text" in below
    assert rows_of(ingest.unusable_documents(rows).select("batch_id", "reasons", "event")) == [
        "Row(batch_id='none', reasons='empty', event=' 　\\n')".replace("　", "\\u3000"),
        "Row(batch_id='text', reasons='malformed', event=' not json\\n')"]
    assert medallion.admitted(rows, "row").filter("accepted").count() == 2
    files = [spark.sparkContext.getConf().get("spark.checkpoint.dir"), str(tmp_path / "b"), str(tmp_path / "r")]
    ingest.ingest_batch(bronze.read_documents(spark, str(landing)), "x-1", *files[1:], as_of=AS_OF)
    assert {r.reasons for r in spark.read.parquet(files[2]).collect()} == {"empty", "malformed"}


@pytest.mark.parametrize("text", ["", " ", "a", " a", "a　", "\n[1]\r\n", "  ", "a b", "é ", None])
def test_trimming_by_the_ends(spark, text):
    frame = spark.createDataFrame([(text,)], "t string")
    got = frame.select(bronze.trimmed(F.col("t")), F.btrim("t", F.lit(C.WHITE_SPACE))).first()
    assert got[0] == got[1]


def test_refused_files_do_not_grow_with_the_deaths(spark, tmp_path, monkeypatch):
    rows = [(i, datetime(2024, 1, 1 + i % 2), 1, "error", 1.0, '{"k": 7}') for i in range(60)]
    spark.createDataFrame(
        rows, "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string"
    ).withColumn("ts", F.col("ts").cast("timestamp_ntz")).coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    seen = []
    monkeypatch.setattr(ingest, "unusable_files", lambda f, m, whole=ingest.unusable_files: seen.append(f.count()) or whole(f, m))
    found = registry.ingest_file_rejects(spark, str(tmp_path)).collect()
    assert sorted(found) == sorted(
        [(f"ev_{i}", "empty" if i % 3 == 0 else "too_large") for i in range(60) if i % 3 < 2] + [("none", "empty")])
    # Twenty deaths by sevens, a blank and a large file for each of two raids.
    assert sum(seen) <= 3 + 4


def test_micro_batches_are_read_from_a_table_that_is_removed(spark, tmp_path, monkeypatch):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text(json.dumps({"batch_id": "b", "events": [event(1), event(2), event(1)]}))
    documents = bronze.read_documents(spark, str(tmp_path / "in"))
    shared, seen = tmp_path / "shared", []
    held_ids = id_index.held_ids
    monkeypatch.setattr(ingest, "scratch_path", lambda spark, name: str(shared / name), raising=False)
    monkeypatch.setattr(id_index, "held_ids", lambda spark, index, events: seen.append(
        events._jdf.queryExecution().executedPlan().toString()) or held_ids(spark, index, events))
    assert ingest.refine_batch(documents, str(tmp_path / "s"), AS_OF, load="x-1") == 2
    # The documents are parsed into a table; its ids are looked up without the cache of whole rows.
    assert "FileScan parquet" in seen[0] and "InMemoryTableScan" not in seen[0]
    assert not list(shared.iterdir())


def test_replay_hands_over_several_steps_in_one_call(spark, sample, tmp_path):
    path = str(tmp_path / "replay")
    bronze.write_replay(bronze.replay_chunks(sample, 5, "tests"), path)
    last = feed.replay_plan(spark, path).agg(F.max("position")).first()[0]
    sent = []
    given = feed.replay_batches(
        spark, path, lambda df: sent.append(df.select("step", "position").collect()), step=1, steps_a_call=3)
    assert given == sum(map(len, sent)) and len(sent) == -(-last // 3)
    assert [sorted({r.step for r in call}) for call in sent] == [
        list(range(first, min(first + 3, last))) for first in range(0, last, 3)]
    assert all(r.position == r.step + 1 for call in sent for r in call)


def test_replay_jobs_do_not_grow_with_the_longest_raid(spark, tmp_path, monkeypatch):
    rows = [(i, datetime(2024, 1, 1), 1, "view", 1.0, '{"k": 7}') for i in range(1300)]
    spark.createDataFrame(
        rows, "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string"
    ).withColumn("ts", F.col("ts").cast("timestamp_ntz")).coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    calls, whole = [], feed.replay_batches
    monkeypatch.setattr(feed, "replay_batches", lambda spark, path, send, *a, **k: whole(
        spark, path, lambda chunks: calls.append(1) or send(chunks), *a, **k))
    sent = registry.replay_sent(spark, str(tmp_path)).collect()
    # 52 chunks of 25 events: three steps of twenty positions, one call.
    assert sorted((r.position, r.call) for r in sent) == [(p, (p - 1) // 20) for p in range(1, 53)]
    assert len(calls) == 1

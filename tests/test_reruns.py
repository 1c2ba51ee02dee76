import json

from emberlog.plans import gold as gold_plan
from emberlog.plans import medallion
from emberlog.schemas import BRIDGE
from emberlog.sources import batch_index, bronze, gold, silver
from pyspark.sql import functions as F

AS_OF = "2024-02-01 00:00:00"


def event(i, **more):
    return {"event_id": f"e{i}", "event_type": "heal", "timestamp": "2024-01-01T00:00:00Z", "raid_id": "raid001",
            "source_player_id": "player_1", "source_player_name": "A", "healing_amount": 2.0, **more}


def layers_of(root):
    return medallion.Layers(*[str(root / name) for name in ("bronze", "silver", "gold", "rejects")])


def test_one_batch_opens_its_own_files_only(spark, tmp_path):
    layers = layers_of(tmp_path)
    (tmp_path / "bronze").mkdir()
    for n in range(6):
        lines = [json.dumps({"batch_id": f"b{n}", "events": [event(2 * n), event(2 * n + 1)]})]
        lines += [json.dumps({"batch_id": "shared", "events": [event(100 + n)]})] * (n % 2)
        (tmp_path / "bronze" / f"{n}.json").write_text("\n".join(lines))
    (tmp_path / "bronze" / "blank.json").write_text("\n")
    index = batch_index.index_path(layers.bronze)
    assert batch_index.index_batches(spark, layers.bronze) == 7
    assert batch_index.index_batches(spark, layers.bronze) == 0
    opened = medallion.batch_documents(spark, layers, "b2").inputFiles()
    assert [f.rsplit("/", 1)[1] for f in opened] == ["2.json"]
    assert len(batch_index.files_of_batch(spark, index, "shared")) == 3
    done = medallion.run_silver(spark, layers, batch_id="shared", as_of=AS_OF)
    assert (done["rows"], done["rows_in"]) == (3, 3)
    # A file that arrives later is indexed alone and found.
    (tmp_path / "bronze" / "late.json").write_text(json.dumps({"batch_id": "shared", "events": [event(200)]}))
    assert medallion.run_silver(spark, layers, batch_id="shared", as_of=AS_OF)["rows"] == 1
    assert medallion.run_silver(spark, layers, batch_id="nowhere", as_of=AS_OF)["status"] == "skipped"
    assert silver.read_silver(spark, layers.silver).count() == 4


def test_every_row_is_accounted_for(spark, tmp_path):
    layers = layers_of(tmp_path)
    (tmp_path / "bronze").mkdir()
    rows = [event(1), event(1), event(2, timestamp="soon"), event(3, raid_id=None), event(4, target_entity_health_pct_after=120)]
    (tmp_path / "bronze" / "a.json").write_text(json.dumps(rows))
    done = medallion.run_silver(spark, layers, as_of=AS_OF)
    assert (done["rows_in"], done["rows"], done["rejected"], done["duplicates_removed"]) == (5, 1, 3, 1)
    refused = spark.read.parquet(f"{layers.rejects}/silver").collect()
    assert {(r.event_id, r.reason) for r in refused} == {
        ("e2", "no_readable_time"), ("e3", "no_raid"), ("e4", "health_out_of_range")}
    # The same load again replaces its own rejects.
    medallion.run_silver(spark, layers, as_of=AS_OF)
    assert spark.read.parquet(f"{layers.rejects}/silver").count() == 3


def test_partition_rerun_reads_no_facts(spark, sample, tmp_path, monkeypatch):
    paths = str(tmp_path / "silver"), str(tmp_path / "gold")
    silver.write_silver(sample, paths[0])
    gold_plan.run_gold(spark, *paths, player_prefix="player_")
    before = sorted(gold.read_gold(spark, paths[1], "dim_player").collect())
    read, known = [], gold_plan.read_gold

    def noted(session, folder, table):
        read.append(table)
        return known(session, folder, table)

    monkeypatch.setattr(gold_plan, "read_gold", noted)
    gold_plan.run_gold_partition(spark, *paths, "raid007", "2024-01-07", player_prefix="player_")
    assert set(read) == {BRIDGE, "dim_player", "dim_raid"}
    assert sorted(gold.read_gold(spark, paths[1], "dim_player").collect()) == before
    bridge = gold.read_gold(spark, paths[1], BRIDGE)
    one = bridge.filter(F.col("raid_id") == "raid007")
    assert all("raid_id=raid007/" in f for f in one.select(F.input_file_name()).distinct().toPandas().iloc[:, 0])
    stats = gold.read_gold(spark, paths[1], "fact_player_raid_stats")
    assert bridge.count() == stats.count()
    counts = {r.player_id: r.n for r in bridge.groupBy("player_id").agg(F.countDistinct("raid_id").alias("n")).collect()}
    assert counts == {r.player_id: r.total_raids for r in gold.read_gold(spark, paths[1], "dim_player").collect()}


def test_rerun_of_a_layer_published_without_a_bridge(spark, sample, tmp_path):
    paths = str(tmp_path / "silver"), str(tmp_path / "gold")
    silver.write_silver(sample, paths[0])
    gold_plan.run_gold(spark, *paths, player_prefix="player_")
    bare = str(tmp_path / "bare")
    for table in ("dim_player", "dim_raid", "fact_raid_summary", "fact_player_raid_stats"):
        gold.write_gold(gold.read_gold(spark, paths[1], table), bare, table)
    gold_plan.run_gold_partition(spark, paths[0], bare, "raid007", "2024-01-07", player_prefix="player_")
    for table in ("dim_player", BRIDGE):
        assert sorted(gold.read_gold(spark, bare, table).collect()) == sorted(gold.read_gold(spark, paths[1], table).collect())

from datetime import date

import pytest

from emberlog.operators import upsert
from emberlog.plans import gold as gold_plan
from emberlog.schemas import DIM_PLAYER_SCHEMA, DIM_RAID_SCHEMA
from emberlog.sources import gold

D = [date(2026, 1, d) for d in range(1, 10)]


def players(spark, *rows):
    return spark.createDataFrame(list(rows), DIM_PLAYER_SCHEMA)


def as_rows(frame):
    return sorted(tuple(r) for r in frame.collect())


OLD = [("a", "Ann", "mage", "dps", D[2], D[4], 3), ("b", "Ben", "monk", "tank", D[1], D[1], 1)]
NEW = [("a", "Anna", "mage", "healer", D[1], D[6], 5), ("c", "Cid", "rogue", "dps", D[5], D[5], 1)]


def test_merge_keeps_the_first_date(spark):
    got = as_rows(upsert.upsert_dim_player(players(spark, *OLD), players(spark, *NEW)))
    assert got == [
        ("a", "Anna", "mage", "healer", D[2], D[6], 5),
        ("b", "Ben", "monk", "tank", D[1], D[1], 1),
        ("c", "Cid", "rogue", "dps", D[5], D[5], 1)]


def test_merge_can_lower_the_first_date(spark):
    got = as_rows(upsert.upsert_dim_player(players(spark, *OLD), players(spark, *NEW), "min"))
    assert got[0][4] == D[1]
    with pytest.raises(ValueError):
        upsert.upsert_dim_player(players(spark), players(spark), "never")


def test_merge_twice_is_merge_once(spark):
    once = upsert.upsert_dim_player(players(spark, *OLD), players(spark, *NEW))
    twice = upsert.upsert_dim_player(once, players(spark, *NEW))
    assert as_rows(once) == as_rows(twice)


def test_null_of_the_source_replaces(spark):
    new = [("a", None, "mage", "dps", D[1], D[6], 5)]
    got = as_rows(upsert.upsert_dim_player(players(spark, OLD[0]), players(spark, *new)))
    assert got[0][1] is None


def test_accumulation_adds(spark):
    got = as_rows(upsert.accumulate_dim_player(players(spark, *OLD), players(spark, *NEW)))
    assert got[0] == ("a", "Ann", "mage", "dps", D[1], D[6], 8)
    assert [r[0] for r in got] == ["a", "b", "c"]


def test_raid_merge_keeps_the_date(spark):
    old = spark.createDataFrame([("raid001", D[1], "X", "Normal", 5, 1.0)], DIM_RAID_SCHEMA)
    new = spark.createDataFrame(
        [("raid001", D[3], "Y", "Heroic", 7, 2.0), ("raid002", D[3], "Z", "Mythic", 1, 2.0)],
        DIM_RAID_SCHEMA)
    assert as_rows(upsert.upsert_dim_raid(old, new)) == [
        ("raid001", D[1], "Y", "Heroic", 7, 2.0), ("raid002", D[3], "Z", "Mythic", 1, 2.0)]


def test_limited_update_columns(spark):
    got = as_rows(upsert.upsert(
        players(spark, *OLD), players(spark, *NEW), ["player_id"], update=["total_raids"]))
    assert got[0] == ("a", "Ann", "mage", "dps", D[2], D[4], 5)


def test_merge_into_a_table(spark, tmp_path):
    path = str(tmp_path / "dim")
    args = (upsert.upsert_dim_player, ["player_id"], DIM_PLAYER_SCHEMA)
    assert gold.merge_table(spark, path, players(spark, *OLD), *args) == 2
    assert gold.merge_table(spark, path, players(spark, *NEW), *args) == 3
    assert as_rows(spark.read.schema(DIM_PLAYER_SCHEMA).parquet(path)) == as_rows(
        upsert.upsert_dim_player(players(spark, *OLD), players(spark, *NEW)))
    with pytest.raises(ValueError):
        gold.merge_table(spark, path, players(spark, OLD[0], OLD[0]), *args)


def test_catalogue_table(spark, tmp_path):
    columns = "raid_id string, event_date date, x bigint"
    schema = spark.createDataFrame([], columns).schema
    for _ in range(2):
        gold.create_table(spark, "facts_t", schema, ("raid_id",), str(tmp_path / "t"))
    first = spark.createDataFrame([("raid001", D[1], 1), ("raid002", D[1], 2)], columns)
    gold.overwrite_partitions(first, "facts_t")
    gold.overwrite_partitions(spark.createDataFrame([("raid002", D[1], 9)], columns), "facts_t")
    assert sorted((r.raid_id, r.x) for r in spark.table("facts_t").collect()) == [
        ("raid001", 1), ("raid002", 9)]
    gold.stage(first, "staged")
    assert spark.sql("SELECT count(*) AS n FROM staged").first().n == 2
    spark.sql("DROP TABLE facts_t")


def test_counting_raids_again_is_idempotent(spark):
    columns = "player_id string, raid_id string"
    known = players(spark, OLD[0])
    published = spark.createDataFrame([("a", "raid001"), ("a", "raid002"), ("z", "raid001")], columns)
    stats = spark.createDataFrame([("a", "raid003")], columns)
    new = players(spark, ("a", "Ann", "mage", "dps", D[8], D[8], 1))
    once = gold_plan.merge_players(known, new, published, stats)
    assert as_rows(once) == [("a", "Ann", "mage", "dps", D[2], D[8], 3)]
    assert as_rows(gold_plan.merge_players(once, new, published, stats)) == as_rows(once)

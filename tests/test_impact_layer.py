"""The impact index as a published table, and its contract."""

import pytest

from emberlog.operators import contract, ranking
from emberlog.plans import gold as gold_plan
from emberlog.session import materialise
from emberlog.sources.gold import read_gold


@pytest.fixture(scope="module")
def tables(sample):
    return gold_plan.gold_tables(sample, "player_", sum_type="decimal(20,4)")


def test_published_beside_the_facts(spark, tables, tmp_path):
    results = gold_plan.publish(tables, str(tmp_path), with_impact=True)
    assert [r["table"] for r in results][-1] == gold_plan.IMPACT
    got = read_gold(spark, str(tmp_path), gold_plan.IMPACT)
    assert got.count() == tables.fact_player_raid_stats.count()
    assert {p.name.split("=")[0] for p in (tmp_path / gold_plan.IMPACT).iterdir() if p.is_dir()} == {"raid_id"}
    ranks = {}
    for row in got.select("raid_id", "impact_rank").collect():
        ranks.setdefault(row.raid_id, []).append(row.impact_rank)
    assert all(sorted(own) == list(range(1, len(own) + 1)) for own in ranks.values())


def test_broken_rows_stop_the_publication(spark, tables, tmp_path):
    longer = tables.fact_player_raid_stats.selectExpr(
        "* EXCEPT (player_name)", "'a name far too long' AS player_name")
    rows = ranking.impact_index(longer)
    broken = {(r["rule"], r["column"]) for r in contract.error_counts(rows, contract.impact_rules()).collect()}
    assert broken == {("length", "player_name")}
    with pytest.raises(ValueError):
        gold_plan.publish(tables._replace(fact_player_raid_stats=longer), str(tmp_path), with_impact=True)
    assert not (tmp_path / gold_plan.IMPACT).exists()


def test_rank_needs_one_shuffle(tables):
    stats = materialise(tables.fact_player_raid_stats, "stats")
    plan = ranking.impact_index(stats)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1

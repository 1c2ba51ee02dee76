import numpy as np
import pytest
from pyspark.sql import functions as F

from emberlog.llm import mixing


def numpy_rake(cells, targets, sweeps=200):
    """cells: list of (source, lang, topic, tokens); targets: a dict of shares per key."""
    tokens = np.array([c[3] for c in cells], float)
    w = np.ones(len(cells))
    for _ in range(sweeps):
        for k in range(3):
            for value, share in targets[k].items():
                own = np.array([c[k] == value for c in cells])
                mass = (tokens * w)[own].sum()
                if mass:
                    w[own] *= share * tokens.sum() / mass
    return w


def test_rake_equals_brute_force(spark):
    rng = np.random.default_rng(1)
    cells = [(f"s{i}", f"l{j}", f"t{k}", int(rng.integers(1, 500))) for i in range(6) for j in range(3) for k in range(2)
             if rng.random() < 0.9]
    total = sum(c[3] for c in cells)

    def power(k, p):
        sums = {}
        for c in cells:
            sums[c[k]] = sums.get(c[k], 0) + c[3]
        raw = {v: n ** p for v, n in sums.items()}
        return {v: n / sum(raw.values()) for v, n in raw.items()}

    targets = [power(0, 0.7), power(1, 0.7), power(2, 0.9)]
    table = spark.createDataFrame(cells, "source string, lang string, topic string, tokens long")
    got = {tuple(r)[:3]: r.weight for r in mixing.rake(table, tolerance=1e-12, max_sweeps=200).collect()}
    want = dict(zip([c[:3] for c in cells], numpy_rake(cells, targets), strict=True))
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k], rel=1e-6) for k in want)
    for k in range(3):
        for value, share in targets[k].items():
            mass = sum(c[3] * got[c[:3]] for c in cells if c[k] == value)
            assert mass == pytest.approx(share * total, rel=1e-6)


def test_given_shares(spark):
    cells = [("a", "x", "t", 100), ("a", "y", "t", 300), ("b", "x", "t", 300), ("b", "y", "t", 100)]
    table = spark.createDataFrame(cells, "source string, lang string, topic string, tokens long")
    sources = spark.createDataFrame([("a", 0.25), ("b", 0.75)], "source string, share double")
    got = mixing.rake(table, shares={"lang": {"x": 0.5, "y": 0.5}}, source_shares=sources).collect()
    assert sum(r.tokens * r.weight for r in got if r.source == "b") == pytest.approx(600, rel=1e-4)
    assert sum(r.tokens * r.weight for r in got if r.lang == "x") == pytest.approx(400, rel=1e-4)


def test_many_languages_are_raked_in_tables(spark):
    rng = np.random.default_rng(2)
    cells = [(f"s{i}", f"l{j}", f"t{k}", int(rng.integers(1, 500))) for i in range(3) for j in range(4) for k in range(2)]
    table = spark.createDataFrame(cells, "source string, lang string, topic string, tokens long")
    for options in ({}, {"shares": {"lang": {"l0": 0.5, "l1": 0.25, "l2": 0.25}}}):
        few = {tuple(r)[:4]: r.weight for r in mixing.rake(table, tolerance=1e-4, **options).collect()}
        many = {tuple(r)[:4]: r.weight for r in mixing.rake(table, tolerance=1e-4, max_values=3, **options).collect()}
        assert few.keys() == many.keys()
        assert all(many[k] == pytest.approx(few[k], rel=1e-3) for k in few)
    assert not any(many[k] for k in many if k[1] == "l3")


def test_unsettled_raking_warns(spark):
    cells = [("a", "x", "t", 900), ("a", "y", "t", 10), ("b", "x", "u", 20), ("b", "y", "t", 500)]
    table = spark.createDataFrame(cells, "source string, lang string, topic string, tokens long")
    with pytest.warns(RuntimeWarning, match="sweeps"):
        mixing.rake(table, max_sweeps=1, tolerance=1e-12)
    with pytest.warns(RuntimeWarning, match="sweeps"):
        mixing.rake(table, max_sweeps=1, tolerance=1e-12, max_values=1)


def test_tokens_do_not_need_blanks():
    import pandas as pd
    texts = pd.Series([None, "", "a", "abcd", "abcde", "語" * 400])
    assert list(mixing.measured(texts).tokens) == [1, 1, 1, 1, 2, 300]


def test_sample_matches_its_probabilities(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "source", "lang")
    rows = mixing.mixed(docs, budget=0.5).select("_cell.*", "_probability", "_kept").collect()
    tokens = sum(r.tokens for r in rows)
    assert len(rows) == docs.count()
    assert sum(r.tokens * r._probability for r in rows) == pytest.approx(0.5 * tokens, rel=1e-3)
    assert sum(r._kept for r in rows) == pytest.approx(sum(r._probability for r in rows), abs=5 * np.sqrt(len(rows)) / 2)
    assert all(0 < r._probability <= 1 for r in rows)


def test_edge_rows_and_columns(spark):
    rows = [(1, None, None, None, 7), (1, None, None, None, 7), (2, "", "a", "en", 8), (None, "x y", "a", "en", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, tokens int")
    out = mixing.mixed(docs, budget=1.0)
    assert out.count() == 4 and out.where("_cell.tokens < 1").count() == 0
    kept = mixing.sample(docs, budget=1.0)
    assert kept.columns == docs.columns
    assert mixing.sample(docs.where("false")).count() == 0
    with_topic = mixing.mixed(docs, topic=F.lit("t"))
    assert {r.topic for r in with_topic.select("_cell.topic").collect()} == {"t"}

import numpy as np
import pytest

from emberlog.llm import neighbours


def brute(rows, k=5, every=50):
    good = [(i, np.array(v, np.float64)) for i, v in rows
            if i is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
    out = []
    for q, x in good:
        if q % every:
            continue
        scored = {}
        for i, y in good:
            if i != q and len(x) == len(y):
                s = float((x * y).sum() / (np.sqrt((x * x).sum()) * np.sqrt((y * y).sum())))
                scored[i] = max(s, scored.get(i, -2))
        out += [(q, r + 1, i, s) for r, (i, s) in enumerate(sorted(scored.items(), key=lambda t: (-t[1], t[0]))[:k])]
    return out


def found(spark, rows, **options):
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    return sorted(tuple(r) for r in neighbours.nearest(table, **options).collect())


def same(got, expected):
    assert [g[:3] for g in got] == [e[:3] for e in sorted(expected)]
    assert np.allclose([g[3] for g in got], [e[3] for e in sorted(expected)], rtol=0, atol=1e-12)


@pytest.mark.parametrize("blocks", [{}, {"query_block": 3, "block": 40}])
def test_equals_brute_force_with_ties(spark, blocks):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=8).astype(np.float32).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[i % 3][1]) for i in range(9)]
    rows += [(400, None), (450, [0.0] * 8), (500, [float("nan")] * 8), (550, [1.0, None] + [1.0] * 6), (600, []),
             (650, [float("inf")] + [1.0] * 7), (None, [1.0] * 8), (700, [1.0, 2.0]), (701, [2.0, 1.0])]
    same(found(spark, rows, **blocks), brute(rows))


def test_close_vectors_need_the_exact_pass(spark):
    rng = np.random.default_rng(2)
    centre = rng.normal(size=64)
    rows = [(i, (centre + 1e-3 * rng.normal(size=64)).astype(np.float32).tolist()) for i in range(400)]
    same(found(spark, rows, block=150), brute(rows))


def test_sample_vectors(spark, small):
    table = spark.read.parquet(f"{small}/embeddings.parquet")
    rows = [(r.vec_id, list(r.embedding)) for r in table.select("vec_id", "embedding").collect()]
    same(sorted(tuple(r) for r in neighbours.nearest(table).collect()), brute(rows))


def test_few_rows_repeats_and_empty_table(spark):
    assert found(spark, []) == []
    assert found(spark, [(0, [1.0, 0.0])]) == []
    got = found(spark, [(0, [1.0, 0.0]), (1, [1.0, 1.0]), (1, [1.0, 0.5]), (1, [1.0, 1.0]), (2, [0.0, 1.0])])
    assert [g[:3] for g in got] == [(0, 1, 1), (0, 2, 2)]
    assert got[0][3] == pytest.approx(1 / np.sqrt(1.25))


def test_components_of_any_size(spark):
    small = [1e-200, 2e-200, 0.5e-200]
    rows = [(0, [1e200, 1e200, 0.0]), (1, [2e200, 2.1e200, 0.0]), (2, small), (3, [1.0, 1.0, 0.1]), (4, [-1e300, 1e-300, 0.0]),
            (50, [3e-310, 0.0, 0.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(tuple(r) for r in neighbours.nearest(table).collect())
    unit = [(i, (np.array(v, np.longdouble) / np.abs(v).max()).astype(np.float64).tolist()) for i, v in rows]
    same(got, brute(unit))


def test_one_id_with_most_rows(spark):
    """A third of all rows share an id, with equal vectors and with different ones."""
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=8).astype(np.float32).tolist()) for i in range(200)]
    rows += [(7, rng.normal(size=8).astype(np.float32).tolist()) for _ in range(60)] + [(9, rows[9][1])] * 60
    rows += [(100, rng.normal(size=8).astype(np.float32).tolist()) for _ in range(30)]
    for blocks in ({}, {"query_block": 3, "block": 40}):
        got = found(spark, rows, **blocks)
        good = {}
        for q, x in rows:
            for i, y in rows:
                if q % 50 == 0 and i != q:
                    x_, y_ = np.array(x, np.float64), np.array(y, np.float64)
                    s = float((x_ * y_).sum() / (np.sqrt((x_ * x_).sum()) * np.sqrt((y_ * y_).sum())))
                    good.setdefault(q, {})[i] = max(s, good.get(q, {}).get(i, -2))
        expected = [(q, r + 1, i, s) for q, own in good.items()
                    for r, (i, s) in enumerate(sorted(own.items(), key=lambda t: (-t[1], t[0]))[:5])]
        same(got, expected)
    # Dealing goes by id and vector, so the commonest id does not fill one block.
    assert neighbours.valid_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).distinct().count() == 290

import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from emberlog.llm import hilbert


@pytest.mark.parametrize(("dimensions", "bits"), [(2, 3), (3, 3), (4, 2)])
def test_curve_visits_every_cell_by_single_steps(spark, dimensions, bits):
    cells = spark.range(1 << (dimensions * bits)).select(*[
        F.shiftright("id", bits * i).bitwiseAND(F.lit((1 << bits) - 1)).alias(f"c{i}") for i in range(dimensions)])
    rows = cells.withColumn("h", hilbert.curve_index([F.col(f"c{i}") for i in range(dimensions)], bits)).orderBy("h").collect()
    assert [r.h for r in rows] == list(range(len(rows)))
    for a, b in zip(rows, rows[1:], strict=False):
        assert sum(abs(a[i] - b[i]) for i in range(dimensions)) == 1


def check(rows, texts, shards=8):
    counts = Counter(r.shard for r in rows)
    assert sum(counts.values()) == len(texts)
    sizes = [counts.get(s, 0) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    for s in range(shards):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sizes[s]))
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == Counter(
        (d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in texts)
    # Shards are runs of the curve.
    ordered = [r.curve for r in sorted(rows, key=lambda r: (r.shard, r.slot))]
    assert ordered == sorted(ordered)


def test_sample_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = hilbert.shard_by_curve(docs).collect()
    check(rows, [(r.doc_id, r.text) for r in docs.collect()])
    # A shard spans few values of each dimension, which is what prunes files.
    spans = [len({r.size_cell for r in rows if r.shard == s}) for s in range(8)]
    assert sum(spans) / 8 < 0.75 * len({r.size_cell for r in rows})


def test_edge_rows(spark):
    rows = [(1, None, None, None, 1), (2, "", "s", "en", 2), (2, "", "s", "en", 2), (None, "é", "s", "fr", 3), (5, "x" * 5000, "zz", "en", 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, size int")
    check(hilbert.shard_by_curve(docs).collect(), [(r[0], r[1]) for r in rows])
    assert hilbert.shard_by_curve(docs.where("false")).count() == 0


def test_written_files(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    hilbert.cut_files(docs, str(tmp_path / "cut"), shards=4)
    back = spark.read.parquet(str(tmp_path / "cut"))
    assert sorted(r.doc_id for r in back.collect()) == sorted(r.doc_id for r in docs.collect())
    assert set(back.columns) == {*docs.columns, "shard"}


def test_files_keep_every_row_whatever_its_names(spark, tmp_path):
    rows = [(1, "a b", "s", "en", "x", "1"), (1, "a b", "s", "en", "y", "2"), (None, None, None, None, "z", "3"), (None, None, None, None, "z", "4")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, shard string, _n string").withColumn("a.b", F.lit("c"))
    hilbert.cut_files(docs, str(tmp_path / "cut"), shards=2)
    back = spark.read.parquet(str(tmp_path / "cut"))
    assert sorted(r._n for r in back.collect()) == ["1", "2", "3", "4"]
    assert set(back.columns) == set(docs.columns)
    assert sorted(r.shard for r in back.collect()) == [0, 0, 1, 1]

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from emberlog.llm import collocations

SCHEMA = "doc_id long, text string, lang string"


def brute(rows, support=10, share=50, first=2000):
    counts, totals = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            for size in (1, 2, 3):
                for i in range(len(words) - size + 1):
                    counts[lang][tuple(words[i:i + size])] += 1
    out = []
    for lang, f in counts.items():
        own = {p: a for p, a in f.items() if len(p) > 1 and a >= support}
        rows_ = []
        for p, a in own.items():
            around = [b for q, b in own.items() if len(q) > len(p) and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))]
            if any(100 * b >= share * a for b in around):
                continue
            s, k = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            rows_.append((-s, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(rows_)[:first], start=1):
            out.append((lang, rank, p.decode(), -a, left, right, totals[lang], -s))
    return sorted(out)


def found(spark, rows, parts=5, **options):
    got = collocations.collocations(spark.createDataFrame(rows, SCHEMA).repartition(parts), **options)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(map(tuple, got.collect()))


def sentences(rng, letters, length):
    return "".join(rng.choice(letters) for _ in range(rng.randint(0, length)))


@pytest.mark.parametrize("options", [{}, {"shards": 1}, {"shards": 7, "support": 4, "share": 90}, {"first": 5}])
def test_random_texts(spark, options):
    rng = random.Random(11)
    rows = [(i, sentences(rng, ["ab ", "B ", "cé  ", "ſ\t", "K", "x.", "y, ", "\n", "\x0b", "\x85", "z "], 60),
             rng.choice(["en", "en", "de", None, "und"])) for i in range(120)]
    mine = {k: v for k, v in options.items() if k != "shards"}
    assert found(spark, rows, **options) == brute(rows, **mine)


def test_sample_documents(spark, small):
    rows = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    assert found(spark, rows) == brute(rows)


def test_repeats_nulls_long_words_and_empty(spark):
    rows = [(1, "w" * 300_000 + " long word", "en")] * 12 + [(None, None, None), (2, "", "fr"), (3, ". , ;", "fr"), (4, "one", "it")]
    rows += [(5, "a b " * 200_000, "xx")]
    assert found(spark, rows) == brute(rows)
    assert found(spark, []) == []


def test_a_dense_bit_map_changes_nothing(spark):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice("abcdefghij") for _ in range(60)), "en") for i in range(80)]
    assert found(spark, rows, filter_bits=18) == found(spark, rows) == brute(rows)


def test_local_supports_prune_and_lose_nothing(spark):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(300)]
    rows = [(i, " ".join(rng.choice(vocabulary) for _ in range(50)) + " often seen", "en") for i in range(400)]
    texts = spark.createDataFrame(rows, SCHEMA).withColumn("shard", (F.col("doc_id") % 3).cast("int"))
    kept = {r.hash & (2**64 - 1) for r in collocations.frequent_somewhere(texts, 10).collect()}
    found = collocations.Phrases([r[1].encode() for r in rows], collocations._seed("en"))
    hashes, counts = found.all_hashes(), found.all_counts()
    assert len(set(hashes.tolist())) == len(hashes)
    assert set(hashes[counts >= 10].tolist()) <= kept
    # At least three shares of a third each: what a shard has fewer than four times is pruned.
    assert kept <= set(hashes[counts >= 4].tolist()) and len(kept) < len(hashes) / 20


def test_small_blocks_and_buckets(spark, monkeypatch):
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choice("abcdefgh") for _ in range(50)), rng.choice(["en", "de"])) for i in range(60)]
    monkeypatch.setattr(collocations, "HELD", 50)
    monkeypatch.setattr(collocations, "BUCKET", 16)
    monkeypatch.setattr(collocations, "pieces_of", lambda batch, column: (batch.slice(i, 1) for i in range(batch.num_rows)))
    assert found(spark, rows) == brute(rows)


def test_counts_travel_in_any_width():
    for top in (1, 255, 256, 65_536, 1 << 40):
        counts = np.array([1, top, 3])
        assert collocations._wide(collocations._narrow(counts)).tolist() == counts.tolist()


def test_scores_beyond_64_bits(spark):
    a, left, right = 987_654_321_987, 1_234_567_890_123, 2_345_678_901_234
    row = spark.createDataFrame([(a, left, right)], "a long, l long, r long").select(collocations.score("a", "l", "r").alias("s")).first()
    assert row.s == 1_000_000 * a * a // (left * right)


def test_phrases_do_not_cross_texts_or_pieces():
    found = collocations.Phrases([b"a b", b"c.d", b""], 0)
    texts, sizes, counts = found.texts_of(lambda h: np.ones(len(h), bool))
    assert sorted(texts.to_pylist()) == ["a", "a b", "b", "c", "d"]
    assert found.n_words == 4

import random
import re

import numpy as np
import pytest
import zstandard

from emberlog.llm import shingle_join

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lowered)
    if 0 < len(words) < 3:
        return {tuple(words)}
    return set(zip(words, words[1:], words[2:], strict=False))


def brute(rows, percent=90):
    sets = [(d, shingles(t)) for d, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, (d, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(sets):
        least[root(i)] = min(least.get(root(i), d), d)
    return sorted((d, len(s), least[root(i)]) for i, (d, s) in enumerate(sets))


def found(spark, rows, **options):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted(tuple(r) for r in shingle_join.similar_groups(docs, **options).collect())


def made_rows(seed, n=150):
    rng = random.Random(seed)
    vocabulary = ["w%d" % i for i in range(400)]
    bases = [[rng.choice(vocabulary) for _ in range(rng.randint(30, 200))] for _ in range(6)]
    common = [rng.choice(vocabulary) for _ in range(8)]
    rows = []
    for i in range(n):
        words = list(rng.choice(bases)) if rng.random() < 0.8 else [rng.choice(vocabulary) for _ in range(rng.randint(1, 60))]
        for _ in range(rng.randint(0, 6)):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        if rng.random() < 0.3:
            words += common
        rows.append((i * 2 + 1, rng.choice([" ", "\n", "\t "]).join(w.upper() if rng.random() < 0.1 else w for w in words)))
    return rows


@pytest.mark.parametrize(("seed", "block"), [(1, 1024), (2, 5)])
def test_equals_brute_force(spark, seed, block):
    rows = made_rows(seed)
    rows += [(2000, ""), (2001, None), (2002, " \n "), (2003, "one"), (2004, "ONE"), (2005, "one two"), (2006, "É one two"),
             (2007, "é one two"), (2008, rows[0][1]), (-5, rows[3][1])]
    assert found(spark, rows, block=block) == brute(rows)


def test_lower_threshold_and_pairs_across_components(spark):
    rows = made_rows(3, 80)
    assert found(spark, rows, percent=60, block=4) == brute(rows, 60)


def test_sample_documents(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    assert sorted(tuple(r) for r in shingle_join.similar_groups(docs).collect()) == brute(rows)


def test_repeated_rows_null_ids_and_extra_columns(spark):
    text = " ".join(f"a{i}" for i in range(50))
    rows = [(4, text, 1, "x"), (4, text, 2, "x"), (None, text + " end", 3, "x"), (9, "other words here now", 4, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, token int, items string")
    got = shingle_join.similar_groups(docs).collect()
    assert sorted((r.doc_id or -1, r.n_shingles, r.component_id) for r in got) == [(-1, 49, None), (4, 48, None), (4, 48, None), (9, 2, 9)]
    kept = shingle_join.one_of_each(docs.where("doc_id is not null"))
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [4, 4, 9]


def test_empty_table(spark):
    assert found(spark, []) == []


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i + 1, i) for i in range(40)] + [(100, 101), (7, 7)], "u long, v long")
    got = {r.node: r.comp for r in shingle_join.components(edges).collect()}
    assert got == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100}


def crowd_rows():
    """Near copies of one text, far apart from each other in part, so that components meet."""
    rng, base, rows = random.Random(8), ["w%d" % i for i in range(100)], []
    for i in range(240):
        words = list(base)
        for _ in range(rng.randint(0, 12)):
            words[rng.randrange(100)] = "x%d" % rng.randrange(10_000)
        rows.append((i, " ".join(words)))
    return rows


def test_no_task_holds_a_crowd(spark, monkeypatch, tmp_path):
    """Crowds beyond a block are not gathered by the screener, and guests are dealt to blocks."""
    most = {"_whole_groups": "token", "_by_group": "key"}
    for name, key in most.items():
        def noted(batches, keys, *rest, real=getattr(shingle_join, name), name=name):
            for rows in real(batches, keys, *rest):
                counts = rows.group_by(list(keys)).aggregate([([], "count_all")])["count_all"].to_pylist()
                with open(tmp_path / name, "a") as out:
                    out.write(f"{max(counts)}\n")
                yield rows
        monkeypatch.setattr(shingle_join, name, noted)
    rows = crowd_rows()
    assert found(spark, rows, block=8) == brute(rows)
    largest = {p.name: max(map(int, p.read_text().split())) for p in tmp_path.iterdir()}
    assert largest.get("_whole_groups", 0) <= 8
    # Hosts and guests, each a block dealt by hash.
    assert 0 < largest["_by_group"] <= 50


def test_sets_in_slices(monkeypatch):
    texts = [" ".join(f"w{i}x{j}" for j in range(40)) for i in range(20)]
    ranks = np.arange(shingle_join.BUCKETS, dtype=np.uint64)
    bodies = [zstandard.ZstdCompressor().compress(t.encode()) for t in texts]
    want = shingle_join.Group(np.arange(20), None, 90, bodies, 3, ranks)
    sizes, hashed = [], shingle_join.ordered_sets
    monkeypatch.setattr(shingle_join, "CHUNK", 500)
    monkeypatch.setattr(shingle_join, "ordered_sets", lambda t, *a: sizes.append(sum(map(len, t))) or hashed(t, *a))
    got = shingle_join.Group(np.arange(20), None, 90, bodies, 3, ranks)
    assert max(sizes) < 1000 and [i.tolist() for i in got.items] == [i.tolist() for i in want.items]


def test_null_ids_link_nothing(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    rows = [(1, a), (2, a + " end"), (3, a), (None, a), (5, b), (6, b), (None, b + " end"), (None, c), (None, c), (None, c + " x"),
            (8, "own words of this"), (8, b), (None, None), (None, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in shingle_join.similar_groups(docs, null_least=False).collect()}
    assert got == {(1, 58, 1), (2, 59, 1), (3, 58, 1), (None, 58, 1), (5, 58, 5), (6, 58, 5), (None, 59, 5), (None, 58, None),
                   (None, 59, None), (8, 2, 5), (8, 58, 5), (None, 0, None)}
    kept = [tuple(r) for r in shingle_join.one_of_each(docs).collect()]
    assert sorted(k[0] for k in kept if k[0] is not None) == [1, 5]
    unnamed = [k[1] for k in kept if k[0] is None]
    assert len(unnamed) == 3 and unnamed.count(None) == 1 and unnamed.count("") == 1
    assert next(t for t in unnamed if t).startswith("c0 c1")

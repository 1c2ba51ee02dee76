import hashlib
import random
import re
from collections import defaultdict

from pyspark.sql import functions as F

from emberlog.llm import exact_copies

SCHEMA = "doc_id long, text string"


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def brute(rows):
    """Expected (doc_id, keep_id, group_size, kept, sha256) of every row."""
    by_text = defaultdict(list)
    for i, (doc, text) in enumerate(rows):
        by_text[norm(text)].append((-len(text or ""), doc is None, doc or 0, i))
    out = []
    for text, own in by_text.items():
        first = min(own)
        for at in own:
            out.append((rows[at[3]][0], rows[first[3]][0], len(own), at == first, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


def found(spark, rows, **options):
    got = exact_copies.groups(spark.createDataFrame(rows, SCHEMA), **options).collect()
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, r.digest.hex()) for r in got), key=repr)


CASES = [(5, "a b"), (3, "ab"), (3, "ab"), (9, "a  b\t"), (1, "a\x0b\x0c\r\nb  "), (7, None), (8, ""), (None, " \n"), (None, "ab"),
         (11, "été 日本"), (12, "été日本"), (13, "a b"), (14, "a b"), (15, "a\x85b"), (-4, "zz"), (4, "zz"),
         ((1 << 63) - 1, "big id"), (-(1 << 63), "big id"), (16, "A b"), (17, "x" * 2_000_000), (18, "x " * 2_000_000)]


def test_cases(spark):
    assert found(spark, CASES) == brute(CASES)


def test_shared_digests_are_told_apart_by_text(spark):
    got = found(spark, CASES * 2 + [(None, "only")], digest=lambda n: F.unhex(F.hex(F.length(n) % 3)))
    assert [g[:4] for g in sorted(got, key=lambda g: repr(g[:4]))] == sorted(
        [g[:4] for g in brute(CASES * 2 + [(None, "only")])], key=repr)


def test_random_rows_and_a_hot_text(spark):
    rng = random.Random(3)
    rows = [(rng.randint(0, 300), "".join(rng.choice("ab \n") for _ in range(rng.randint(0, 6)))) for _ in range(600)]
    rows += [(rng.randint(0, 99), "hot text" + " " * rng.randint(0, 3)) for _ in range(300)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(7)
    for salts in (1, 3):
        got = exact_copies.groups(frame, salts=salts).collect()
        assert sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, r.digest.hex()) for r in got), key=repr) == brute(rows)


def test_keys_beyond_the_heavy_limit(spark, monkeypatch):
    monkeypatch.setattr("emberlog.llm.common.HEAVY_KEYS", 1)
    assert found(spark, CASES) == brute(CASES)


def test_empty_table(spark):
    assert found(spark, []) == []


def test_deduplicate_keeps_columns_of_any_name(spark):
    names = ["doc_id", "text", "row", "digest", "norm", "order", "variant", "salt", "first", "best", "group_size", "kept", "doc", "load"]
    rows = [(d, t, *range(len(names) - 2)) for d, t in CASES]
    frame = spark.createDataFrame(rows, ", ".join(f"{n} {t}" for n, t in zip(names, ["long", "string"] + ["int"] * 12, strict=True)))
    got = exact_copies.deduplicate(frame)
    assert got.columns == names
    kept = [(k[0], k[4]) for k in brute(CASES) if k[3]]
    assert sorted(((r.doc_id, hashlib.sha256(norm(r.text).encode()).hexdigest()) for r in got.collect()), key=repr) == sorted(kept, key=repr)


def test_no_python_in_the_plan(spark, small):
    plan = exact_copies.groups(spark.read.parquet(f"{small}/documents.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "SortAggregate" not in plan

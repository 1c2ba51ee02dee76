"""Stages of the pipeline keep columns of any name, nulls in ids included."""

from emberlog.llm import mixing, secrets, shingle_join

NAMES = ["_id", "_crc", "_spans", "_seen", "_key", "_cell", "_kept", "_weight", "_probability", "_gone", "_digest", "_one",
         "doc", "id", "key", "spans", "clean", "digest", "one", "text_crc32", "topic", "repo", "owner", "a.b"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` string" for n in NAMES)
SECRET = "password = hunter2hunter2 and more words to read here"


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "en", s, len(t or ""), *NAMES) for d, t, s in rows], SCHEMA)


ROWS = [(1, "one two three four five six seven", "a"), (2, "one two three four five six seven", "b"), (None, "alone " * 9, "a"),
        (None, "alone " * 9, "a"), (None, None, None), (7, SECRET, "a"), (None, SECRET, "a"), (8, "", "b")]


def same_columns(got, docs):
    assert got.columns == docs.columns
    rows = got.collect()
    assert all(tuple(r)[5:] == tuple(NAMES) for r in rows)
    return rows


def test_one_of_each(spark):
    docs = frame(spark, ROWS)
    rows = same_columns(shingle_join.one_of_each(docs), docs)
    # One row of the null ids' group stays; the secret's group has an id, so its row without one goes.
    assert sorted((r.doc_id or 0, r.text or "") for r in rows) == sorted(
        [(1, ROWS[0][1]), (0, "alone " * 9), (0, ""), (7, SECRET), (8, "")])


def test_redact(spark):
    docs = frame(spark, ROWS)
    rows = same_columns(secrets.redact(docs), docs)
    assert len(rows) == len(ROWS)
    changed = [r for r in rows if r.text and "[assign]" in r.text]
    assert sorted(r.doc_id or 0 for r in changed) == [0, 7]
    assert all(r.n_chars == len(r.text) and "hunter2" not in r.text for r in changed)
    assert sorted(r.text or "" for r in rows if r not in changed) == sorted(t or "" for _, t, _ in ROWS if t != SECRET)


def test_sample(spark):
    docs = frame(spark, ROWS + [(None, f"text number {i}", "a") for i in range(200)])
    rows = same_columns(mixing.sample(docs, budget=0.5), docs)
    # Rows without an id are drawn one by one, not together.
    drawn = sum((r.text or "").startswith("text number") for r in rows)
    assert 40 < drawn < 200

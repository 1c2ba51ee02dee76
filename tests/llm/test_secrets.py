import hashlib
import random
import re

from emberlog.llm import secrets

KEY = "AbCdEf0123456789GhIjKl"


def brute_base(text):
    """The contract's patterns as they stand, matches that fail dropped afterwards."""
    spans = []
    for kind, pattern, least, group in (
            ("assign", r"(?ai:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 6, 2),
            ("access", r"AKIA[A-Z0-9]+", 20, 0), ("hex", r"[0-9a-f]+", 24, 0)):
        spans += [(kind, *m.span()) for m in re.finditer(pattern, text) if len(m[group]) >= least]
    return sorted(spans, key=lambda s: (s[1], secrets.KINDS.index(s[0])))


def test_base_equals_brute_force():
    rng = random.Random(1)
    parts = ["password", "PassWd", "token", "api_key", "apikey", "secret", "=", ": ", "'", '"', " ", "abc", "AKIA", "QWERTY0123456789",
             "0123456789abcdef", "fedc", "é", "ſecret", "\n", "x.y", "-", "toKen"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 30)))
        assert [s[:3] for s in secrets.base_spans(text)] == brute_base(text)


def made(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, kind string")


ROWS = [
    (1, f"my password={'a1' * 8} end", "one", "en", "k"),
    (2, "password=changeme1 here", "one", "en", "k"), (3, "say password=changeme1", "two", "en", "k"),
    (4, f"key {KEY} there", "one", "en", "k"), (5, f"é {KEY}2 there", "one", "en", "k"), (6, f"{KEY}2", "two", "fr", "k"),
    (7, None, None, None, None), (8, "", "two", "en", "k"), (2, "password=changeme1 here", "one", "en", "k"),
]


def test_ownership_and_spans(spark):
    got = {}
    for r in secrets.find_secrets(made(spark, ROWS), max_owners=1).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert len(got[2]) == 2 and got[2][0].spans == got[2][1].spans
    spans = {d: [(s.kind, s.start, s.stop, s.owners, s.repos, s.live) for s in rows[0].spans] for d, rows in got.items()}
    assert spans[1] == [("assign", 3, 28, 1, 1, True)]
    assert spans[2] == [("assign", 0, 18, 2, 2, False)]
    # A mixed token is reported only while one owner alone has it.
    assert spans[4] == [("live", 4, 26, 1, 1, True)]
    assert spans[5] == spans[6] == spans[7] == spans[8] == []
    assert got[2][0].base_sha256 == hashlib.sha256(b"assign:0:18").hexdigest()
    assert got[7][0].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert (got[2][0].n_assign, got[2][0].n_access, got[2][0].n_hex) == (1, 0, 0)


def test_redaction(spark):
    docs = made(spark, ROWS)
    got = {}
    for options in ({}, {"max_broadcast": 0}):
        out = secrets.redact(docs, max_owners=1, **options)
        assert out.columns == docs.columns
        got = sorted((r.doc_id, r.text) for r in out.collect() if r.text is not None)
        assert dict(got)[1] == "my [assign] end"
        assert dict(got)[3] == "say password=changeme1"
        assert dict(got)[4] == "key [live] there"
        assert len(got) == len(ROWS) - 1


def test_sample_documents_keep_every_base_span(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in secrets.find_secrets(docs).collect():
        base = brute_base(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in base).encode()).hexdigest()
        assert [(s.kind, s.start, s.stop) for s in r.spans if s.kind != "live"] == base


def test_empty_table(spark):
    assert secrets.find_secrets(made(spark, [])).count() == 0
    assert secrets.redact(made(spark, [])).count() == 0


def test_owners_and_repositories_both_decide(spark):
    """A copy in a second owner hides nothing; many owners, or many repositories of one, make an example."""
    rows = [(i, f"token = {value}", source, lang, "k") for i, (value, source, lang) in enumerate(
        [("copied-once-1", s, "en") for s in ("one", "two")]
        + [("three-owners-1", s, "en") for s in ("one", "two", "three")]
        + [("one-owner-4", "one", x) for x in "abcd"] * 20 + [("one-owner-50", "one", f"r{i}") for i in range(50)])]
    live = {}
    for r in secrets.find_secrets(made(spark, rows)).collect():
        live.setdefault(rows[r.doc_id][1], set()).add((r.spans[0].live, r.spans[0].owners, r.spans[0].repos))
    assert live == {"token = copied-once-1": {(True, 2, 2)}, "token = three-owners-1": {(False, 3, 3)},
                    "token = one-owner-4": {(True, 1, 4)}, "token = one-owner-50": {(False, 1, 50)}}
    kept = {r.text for r in secrets.redact(made(spark, rows)).collect()}
    assert kept == {"[assign]", "token = three-owners-1", "token = one-owner-50"}


def test_very_long_text(spark):
    text = "filler words " * 200_000 + "password = hunter2hunter2 " + "x" * 1_000_000
    row = secrets.find_secrets(made(spark, [(1, text, "one", "en", "k")])).first()
    assert [(s.kind, s.start) for s in row.spans] == [("assign", 13 * 200_000)]

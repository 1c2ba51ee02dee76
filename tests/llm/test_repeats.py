import hashlib
import random
import zlib

import numpy as np
import pytest

from emberlog.llm import repeats

L = repeats.LENGTH


def brute(rows):
    """(doc_id, text) in order -> removed spans per document, by a table of all windows."""
    seen, spans = {}, {}
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    for doc, text in order:
        data = (text or "").encode()
        covered = np.zeros(len(data) + 1, np.int64)
        for s in range(len(data) - L + 1):
            window = data[s:s + L]
            if window in seen:
                covered[s] += 1
            seen.setdefault(window, (doc, s))
        gone = np.zeros(len(data), bool)
        for s in np.flatnonzero(covered):
            gone[s:s + L] = True
        edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
        kept = bytes(np.frombuffer(data, np.uint8)[~gone])
        spans[doc] = (len(data), [tuple(e) for e in edges.reshape(-1, 2).tolist()], hashlib.sha256(kept).hexdigest())
    return spans


def found(spark, rows, **options):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return {r.doc_id: (r.n_bytes, [(s.start, s.stop) for s in r.spans], r.kept_sha256)
            for r in repeats.remove_repeats(docs, **options).collect()}


def made_rows(seed, n=60, letters="ab c"):
    rng = random.Random(seed)
    passages = ["".join(rng.choice(letters) for _ in range(rng.randint(80, 400))) for _ in range(6)]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(rng.randint(0, 4)):
            parts.append(rng.choice(passages)[rng.randint(0, 60):] if rng.random() < 0.6
                         else "".join(rng.choice("abcdefgh é") for _ in range(rng.randint(0, 300))))
        rows.append((i * 3, "".join(parts)))
    return rows


@pytest.mark.parametrize("limit", [50_000, 3])
def test_equals_brute_force(spark, limit):
    rows = made_rows(1)
    rows += [(1000, rows[5][1]), (1001, "a" * 700), (1002, "ab" * 400), (1003, None), (1004, ""), (-7, rows[9][1]),
             (1005, "\x00" * 250 + "x" * 130), (1006, "x" * 99)]
    assert found(spark, rows, group_limit=limit) == brute(rows)


def test_sample_documents(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    got = {r.doc_id: (r.n_bytes, [(s.start, s.stop) for s in r.spans], r.kept_sha256)
           for r in repeats.remove_repeats(docs).collect()}
    assert got == brute(rows)


def test_repeated_rows_and_clashing_columns(spark):
    text = "".join(chr(97 + i * 7 % 26) for i in range(300))
    other = made_rows(2, 3)[0][1] + "xyz" * 50
    rows = [(5, text, 1, "q"), (5, text, 2, "q"), (9, text, 3, "q"), (None, other, 4, "q")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, a int, place string")
    got = sorted(((r.doc_id or -1, r.n_removed) for r in repeats.remove_repeats(docs).collect()))
    assert got[1:] == [(5, got[1][1]), (5, got[1][1]), (9, 300)]
    once = repeats.remove_repeats(docs.limit(1)).first()
    assert got[1][1] == once.n_removed


def test_empty_table(spark):
    assert repeats.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_long_text_in_slices(spark, monkeypatch):
    monkeypatch.setattr(repeats, "CHUNK_BYTES", 1000)
    rng = random.Random(3)
    text = "".join(rng.choice("abcdefgh") for _ in range(5000))
    data = [(0, text + text[100:900]), (1, text[1500:4000])]
    out = {}
    for batch in repeats._runs(iter([repeats.batch_of(
            {"doc": [r[0] for r in data], "text": [r[1] for r in data]},
            repeats.pa.schema([("doc", repeats.pa.int64()), ("text", repeats.pa.string())]))])):
        for r in batch.to_pylist():
            _, start, count, _ = repeats.unpacked(r["place"])
            for s in range(start, start + count):
                assert s not in out.setdefault(r["doc"], set())
                out[r["doc"]].add(s)
    assert out == {d: set(range(len(t) - L + 1)) for d, t in data}


def test_blind_trie_sorts():
    rng = random.Random(4)
    strings = [bytes(rng.choice(b"ab\x00") for _ in range(rng.randint(0, 12))) for _ in range(200)]
    order = repeats.blind_trie_order(strings)
    assert [strings[i] for i in order] == sorted(strings)


def test_deep_shallow_orders_groups():
    rng = random.Random(5)
    stems = [bytes(rng.choice(b"xy") for _ in range(60)) for _ in range(3)]
    strings = [rng.choice(stems)[: rng.randint(0, 60)] + bytes(rng.choice(b"xy") for _ in range(rng.randint(0, 40))) for _ in range(300)]
    groups = np.sort(np.array([rng.randint(0, 5) for _ in strings]))
    rows, lengths = np.zeros((300, 104), np.uint8), np.array([len(s) for s in strings])
    for i, s in enumerate(strings):
        rows[i, : len(s)] = np.frombuffer(s, np.uint8)
    order, shared = repeats.deep_shallow(rows, lengths, groups)
    got = [(groups[i], strings[i]) for i in order]
    assert got == sorted(got)
    for k in range(1, 300):
        i, j = order[k - 1], order[k]
        expected = -1 if groups[i] != groups[j] else repeats.lcp(strings[i], strings[j])
        assert shared[k] == expected


def test_many_texts_without_an_id(spark):
    """Texts that share a null id and 16 bits of checksum keep what is their own."""
    passage = "".join(chr(97 + i * i % 26) + chr(97 + i % 23) for i in range(100))
    by_crc, pair = {}, None
    for i in range(5000):
        text = " ".join(hashlib.sha256(b"%d %d" % (i, k)).hexdigest() for k in range(4))
        # The second text is the one a passage of which came before.
        for t in (text, text[:120] + passage + text[120:]):
            other = by_crc.setdefault(zlib.crc32(t.encode()) & 0xFFFF, t)
            if other is not t and (passage in t) != (passage in other):
                pair = sorted([t, other], key=len)
        if pair:
            break
    rows = [(None, pair[0]), (None, pair[1]), (None, "x" * 30 + passage), (7, passage + "end")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.n_bytes, r.n_removed) for r in repeats.remove_repeats(docs).collect()}
    assert (None, len(pair[0]), 0) in got
    removed = sorted(r[2] for r in got if r[1] != len(pair[0]))
    # The passage stays once, in one of the texts without an id.
    assert removed == [0, 200, 200] and (7, 203, 200) in got

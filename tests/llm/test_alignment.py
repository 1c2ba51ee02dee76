import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from emberlog.llm import alignment, tokens

ODD = ["plain words here", "a  b\t\n c\r\n", "\x00\x01", "été naïve ñandú", "日本語テキスト", "it's we'll", "🙂🙃 x", "<|endoftext|> in a text",
       "<s> and </s> <unk> <0x41>", "    wide", "▁ low line", "1234567 89.5", "a" * 3000, "́combining", " ", "\n", "x"]


@pytest.fixture(scope="module")
def reference():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def byte_alphabet():
    """Byte of each character of the byte-level alphabet: printable bytes stand for themselves, others follow from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def ranges(parts):
    out, at = [], 0
    for token, part in parts:
        out.append((token, at, at + len(part)))
        at += len(part)
    return out


def brute(rows, reference):
    """Expected rows, by comparing every A token with every B token."""
    model_a, model_b = reference
    letters = byte_alphabet()
    docs, counts = [], Counter()
    for doc, text in rows:
        a = b = []
        if text:
            ids = model_a.encode(" " + text, add_special_tokens=False).ids
            a = ranges([(i, bytes(letters[c] for c in model_a.id_to_token(i))) for i in ids])
            pieces = model_b.encode(text)
            b = ranges([(i, bytes([int(model_b.id_to_piece(i)[3:5], 16)]) if model_b.is_byte(i)
                         else model_b.id_to_piece(i).replace("▁", " ").encode()) for i in pieces])
            joined = b"".join(bytes([int(model_b.id_to_piece(i)[3:5], 16)]) if model_b.is_byte(i)
                              else model_b.id_to_piece(i).replace("▁", " ").encode() for i in pieces)
            if joined != (" " + text).encode():
                a = b = []
        own = [(x, y) for x, s, e in a for y, u, v in b if s < v and u < e]
        counts.update(own)
        cuts = sorted({e for *_, e in a} & {e for *_, e in b})
        groups, low = [], 0
        for cut in cuts:
            groups.append([[x for x, s, e in side if low <= s and e <= cut] for side in (a, b)])
            low = cut
        docs.append((doc, a, b, own, groups))
    most = defaultdict(int)
    for (_, y), n in counts.items():
        most[y] = max(most[y], n)
    out = []
    for doc, a, b, own, groups in docs:
        text = ";".join("|".join(",".join(map(str, side)) for side in group) for group in groups)
        out.append((doc, len(a), len(b), len(groups), len(own), sum(counts[p] == most[p[1]] for p in own),
                    sum(counts[p] for p in own), hashlib.sha256(text.encode()).hexdigest() if a else ""))
    return sorted(out, key=repr)


def found(spark, rows, parts=3):
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    got = alignment.align_documents(frame)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return sorted(map(tuple, got.collect()), key=repr)


def test_odd_texts_repeats_and_nulls(spark, reference):
    rows = [*enumerate(ODD), (50, None), (51, ""), (3, ODD[3]), (3, ODD[3]), (None, "nobody"), (None, None), (-7, "x y")]
    assert found(spark, rows) == brute(rows, reference)


def test_sample_documents(spark, small, reference):
    rows = [(r.doc_id, r.text[:600]) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    assert found(spark, rows) == brute(rows, reference)


def test_random_letters(spark, reference, monkeypatch):
    rng = random.Random(5)
    rows = [(i, "".join(rng.choice("ab ▁é日\n<0x4>'s.") for _ in range(rng.randint(0, 40)))) for i in range(150)]
    assert found(spark, rows) == brute(rows, reference)
    monkeypatch.setattr("emberlog.llm.common.HEAVY_KEYS", 3)
    assert found(spark, rows, 1) == brute(rows, reference)


def test_empty_table(spark):
    assert found(spark, []) == []


@pytest.mark.parametrize("text", [" " * 2_000_000, "\t" * 2_000_000 + "x", "x" + "\n" * 2_000_000, "w" * 2_000_000])
def test_very_long_runs(reference, text):
    mine = tokens.ByteIds().ids(text)
    assert mine.tolist() == reference[0].encode(text, add_special_tokens=False).ids
    aligner = alignment.Aligner()
    (n_a, n_b, n_groups, n_links, *_), = aligner.align([text])
    assert n_a > 0 and n_b > 0 and n_groups <= min(n_a, n_b) and n_links >= max(n_a, n_b)


def test_groups_of_tiles():
    a, b = alignment.coalesced(np.array([2, 5, 6, 9]), np.array([1, 2, 6, 9]))
    assert a.tolist() == [0, 1, 1, 2] and b.tolist() == [0, 0, 1, 2]
    x, y = alignment.links(np.array([2, 5, 6, 9]), np.array([1, 2, 6, 9]))
    assert list(zip(x.tolist(), y.tolist(), strict=True)) == [(0, 0), (0, 1), (1, 2), (2, 2), (3, 3)]

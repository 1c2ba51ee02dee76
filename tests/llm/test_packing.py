import random
import zlib
from collections import defaultdict
from itertools import combinations_with_replacement

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from emberlog.llm import packing

ODD = ["", "plain words here", "a  b\t\n c\r\n", "\x00\x01", "été naïve ñandú", "日本語テキスト", "it's we'll I'd", "🙂🙃 x", "<|endoftext|> in a text",
       "    wide", "1234567 89.5", "a" * 3000, "__init__(self)->None;", "́combining", "ſ K İ"]


def test_ids_equal_the_tokenizer_file():
    reference = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    reference.encode_special_tokens = True
    code = packing.encoder()
    for text in ODD:
        assert code.encode_ordinary(text) == reference.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", [" " * 2_000_000, "\t" * 2_000_000, "a" + "\n" * 2_000_000, "w" * 2_000_000])
def test_very_long_runs(text):
    reference = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    reference.encode_special_tokens = True
    assert packing.encoder().encode_ordinary(text) == reference.encode(text, add_special_tokens=False).ids


def test_pack_a_text_of_blanks(spark):
    check(spark, [(1, "x" + " " * 1_500_000 + "y"), (2, "short")])


def check(spark, rows, length=1024, **options):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = packing.pack(docs, length=length, **options).collect()
    code = packing.encoder()
    ids = defaultdict(list)
    for doc, text in rows:
        ids[doc].append(np.append(np.array(code.encode_ordinary(text or ""), np.uint32), packing.SEPARATOR).astype("<u4"))
    pieces, bins = defaultdict(list), defaultdict(list)
    for r in out:
        pieces[r.doc_id].append(r)
        bins[r.sequence_id].append(r)
    assert set(pieces) == set(ids)
    for doc, own in pieces.items():
        if len(ids[doc]) == 1:
            tokens = ids[doc][0]
            own.sort(key=lambda r: r.piece)
            assert [r.piece for r in own] == list(range(-(-len(tokens) // length)))
            assert [r.start for r in own] == np.cumsum([0, *[r.length for r in own]])[:-1].tolist()
            assert sum(r.length for r in own) == len(tokens)
            assert all(r.length == length for r in own[1:])
            for r in own:
                assert r.ids_crc32 == zlib.crc32(tokens[r.start:r.start + r.length].tobytes())
        else:
            assert sum(r.length for r in own) == sum(map(len, ids[doc]))
    for own in bins.values():
        own.sort(key=lambda r: r.offset)
        assert [r.offset for r in own] == np.cumsum([0, *[r.length for r in own]])[:-1].tolist()
        assert sum(r.length for r in own) <= length
    return out, len(bins)


def test_sample_documents(spark, small):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    out, bins = check(spark, rows)
    assert bins <= packing.lower_bound(np.array([r.length for r in out])) + 1


def test_odd_texts_repeats_and_null(spark):
    rows = list(enumerate(ODD)) + [(50, None), (51, ODD[1]), (51, ODD[1]), (None, "x")]
    check(spark, rows)
    check(spark, rows, length=16)


def test_partitions_exchange(spark):
    rng = random.Random(1)
    rows = [(i, " a" * rng.randint(1, 90)) for i in range(600)]
    out, bins = check(spark, rows, length=100, per_partition=40)
    assert len({r.turn for r in out}) > 1
    _, once = check(spark, rows, length=100, per_partition=40, rounds=1)
    assert bins <= once
    # Fifteen partitions of forty pieces: at most about one open bin more in each.
    _, _, alone = packing.best_fit(np.array([r.length for r in out]), 100)
    assert bins <= alone + 25


def test_empty_table(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def least_bins(sizes, length):
    """Fewest bins by trying all ways; small inputs."""
    best = len(sizes)

    def place(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(sizes):
            best = len(rooms)
            return
        for k in range(len(rooms)):
            if rooms[k] >= sizes[i]:
                rooms[k] -= sizes[i]
                place(i + 1, rooms)
                rooms[k] += sizes[i]
        place(i + 1, [*rooms, length - sizes[i]])

    place(0, [])
    return best


@pytest.mark.parametrize("length", [6, 10])
def test_bound_is_never_above_the_optimum(length):
    for sizes in combinations_with_replacement(range(1, length + 1), 5):
        assert packing.lower_bound(np.array(sizes), length) <= least_bins(sorted(sizes, reverse=True), length)
    assert packing.lower_bound(np.array([6, 6, 6]), 10) == 3

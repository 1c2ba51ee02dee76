"""Collocations: phrases of two or three words that occur together more than chance has it.

SON partitioning over documents dealt to ``shards`` shards by a hash:

1. Each shard is mined completely.  Tasks combine what they read into (shard, phrase hash,
   count), as sorted blocks of one bucket of hashes each; a bucket's blocks meet in one task
   and are added up, and a shard keeps what reaches its own support: the global support
   lowered in proportion to its share of the language's words, rounded up.  A phrase with
   global support must reach that in at least one shard.  The number of buckets follows the
   number of words, so a bucket stays at some four million phrases.
2. The union of the locally frequent hashes is laid into a bit map, built in blocks by Spark
   and bounded by ``filter_bits`` (sent to the tasks; 32 MB at most).
3. All phrases whose hash is marked are counted over the whole corpus, as text, exactly.
   Whatever the map lets through by chance falls below the support here.

A shard is a part of the table, not a task: it may be mined by any number of tasks, and with
few shards the local supports stay above one, which is what makes them prune.  When the map
is denser than one bit in a few (more than some 2^26 frequent phrases), more phrases reach
step 3; results stay the same and its shuffle is at most that of counting all phrases.

Cuts, containment and ranks work on the frequent phrases only.  The counts of a phrase's
parts are looked up in a join that broadcasts the parts asked for most, so that one word
beginning a third of all phrases is no hot key; a language's first rows are found in parts
before they are compared.

Defined results: null text counts as empty, null language as ``und``; repeated rows count
each; words never cross the separators; an empty table gives no rows.  Only text, lang and
doc_id are read (doc_id for dealing alone).  A task holds the words of about ``CHUNK_BYTES``
of text, or of one longer text, ``HELD`` combined phrases, and one bucket.
"""

from __future__ import annotations

import itertools
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emberlog.llm.common import batch_of, map_arrow, pieces_of, table, weighted_join
from emberlog.session import small_side

SUPPORT, SHARE, FIRST = 10, 50, 2000
SHARDS = 3
PARTS = 16
FILTER_BITS = 28
BLOCK_BITS = 18
# Phrases that a task combines before they travel, and phrases of one bucket of hashes.
HELD, BUCKET = 1 << 22, 1 << 22
# Separators of pieces and of words, as the contract fixes them.
PIECE_ENDS, BLANKS = b".,;:!?\x0a\x0b\x0c\x0d", b"\x20\x09"
WORD = r"[^\x20\x09.,;:!?\x0A-\x0D]+"

# Every piece end becomes a full stop, which then stands as a token of its own.
_LETTERS = bytes(
    ord(".") if b in PIECE_ENDS else ord(" ") if b in BLANKS else b + 32 if 65 <= b <= 90 else b for b in range(256))
_ODD = np.uint64(0x9E3779B97F4A7C15)


def words_of(texts: list[bytes]) -> list[bytes]:
    """All words of the texts in order, with a full stop wherever a piece ends."""
    return b" . ".join(text.translate(_LETTERS).replace(b".", b" . ") for text in texts).split(b" ")


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _ODD
    return h ^ (h >> np.uint64(29))


class Phrases:
    """The distinct phrases of one to three words in some texts: ids of their words, hash and count."""

    def __init__(self, texts: list[bytes], seed: int):
        number: dict[bytes, int] = defaultdict(itertools.count().__next__)
        # Number 0 is the end of a piece; empty strings between blanks are no words.
        number[b"."]
        words = [w for w in words_of(texts) if w]
        ids = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
        self.words = list(number)
        hashes = np.fromiter((xxhash.xxh3_64_intdigest(w, seed) for w in self.words), np.uint64, len(self.words))
        n = len(self.words)
        inside = ids > 0
        self.n_words = int(inside.sum())
        unique, counts = np.unique(ids[inside], return_counts=True)
        self.members = [(unique,)]
        self.counts = [counts]
        self.hashes = [_mixed(hashes[unique])]
        two = inside[:-1] & inside[1:]
        first = np.flatnonzero(two)
        codes, of_pair, counts = np.unique(ids[first] * n + ids[first + 1], return_inverse=True, return_counts=True)
        a, b = np.divmod(codes, max(n, 1))
        self._add((a, b), counts, hashes)
        # A triple is a numbered pair and one more word, so its code stays within 64 bits.
        three = np.flatnonzero(two[first] & inside[np.minimum(first + 2, len(ids) - 1)] & (first + 2 < len(ids)))
        codes, counts = np.unique(of_pair[three] * n + ids[first[three] + 2], return_counts=True)
        pair, c = np.divmod(codes, max(n, 1))
        self._add((a[pair], b[pair], c), counts, hashes)

    def _add(self, members: tuple[np.ndarray, ...], counts: np.ndarray, hashes: np.ndarray) -> None:
        h = hashes[members[0]]
        for m in members[1:]:
            h = _mixed(h) + hashes[m]
        self.members.append(members)
        self.counts.append(counts)
        self.hashes.append(_mixed(h + np.uint64(len(members))))

    def all_hashes(self) -> np.ndarray:
        return np.concatenate(self.hashes)

    def all_counts(self) -> np.ndarray:
        return np.concatenate(self.counts)

    def texts_of(self, marked) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """Text, number of words and count of the phrases whose hash ``marked`` accepts."""
        words = pa.array(self.words, pa.large_binary())
        texts, sizes, counts = [], [], []
        for size, (members, own, h) in enumerate(zip(self.members, self.counts, self.hashes, strict=True), start=1):
            taken = np.flatnonzero(marked(h))
            parts = [words.take(pa.array(m[taken])) for m in members]
            joined = pc.binary_join_element_wise(*parts, pa.scalar(b" ", pa.large_binary())) if size > 1 else parts[0]
            texts.append(joined)
            sizes.append(np.full(len(taken), size, np.int32))
            counts.append(own[taken])
        return pa.concat_arrays(texts).cast(pa.large_string()), np.concatenate(sizes), np.concatenate(counts)


def _by_group(part: pa.RecordBatch, columns: list[str]):
    """(values of ``columns``, texts) of each group of rows in a batch."""
    groups: dict[tuple, list[bytes]] = defaultdict(list)
    keys = zip(*(part[c].to_pylist() for c in columns), strict=True)
    for key, text in zip(keys, part["text"].cast(pa.large_binary()).to_pylist(), strict=True):
        groups[key].append(text)
    return groups.items()


def _seed(lang: str) -> int:
    return xxhash.xxh3_64_intdigest(lang.encode())


def summed(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes in order, and the sum of each one's counts."""
    order = np.argsort(hashes)
    hashes, counts = hashes[order], counts[order]
    first = np.flatnonzero(np.concatenate([[len(hashes) > 0], hashes[1:] != hashes[:-1]]))
    return hashes[first], np.add.reduceat(counts, first) if len(first) else counts


BLOCKS = "bucket long, lang string, shard int, least long, hashes binary, counts binary"


def local_counts(texts: DataFrame, bucket_bits: int) -> DataFrame:
    """Counts of all phrases of each (lang, shard), combined over ``HELD`` phrases of a task.

    A row holds the sorted hashes of one bucket, that is, with the same first ``bucket_bits``
    bits, and their counts.
    """
    schema = pa.schema([("bucket", pa.int64()), ("lang", pa.string()), ("shard", pa.int32()), ("least", pa.int64()),
                        ("hashes", pa.binary()), ("counts", pa.binary())])

    def run(batches):
        held: dict[tuple, list] = defaultdict(list)
        size = 0

        def emptied():
            for (lang, shard, least), parts in held.items():
                hashes, counts = summed(*(np.concatenate(x) for x in zip(*parts, strict=True)))
                if not len(hashes):
                    continue
                buckets = (hashes >> np.uint64(64 - bucket_bits)).astype(np.int64) if bucket_bits else np.zeros(len(hashes), np.int64)
                first = np.flatnonzero(np.concatenate([[True], buckets[1:] != buckets[:-1]])).tolist()
                cuts = list(zip(first, [*first[1:], len(buckets)], strict=True))
                n = len(cuts)
                yield batch_of({"bucket": buckets[first], "lang": [lang] * n, "shard": [shard] * n, "least": [least] * n,
                                "hashes": [hashes[a:b].tobytes() for a, b in cuts],
                                "counts": [_narrow(counts[a:b]) for a, b in cuts]}, schema)
            held.clear()

        for batch in batches:
            for part in pieces_of(batch, "text"):
                for key, own in _by_group(part, ["lang", "shard", "least"]):
                    found = Phrases(own, _seed(key[0]))
                    held[key].append((found.all_hashes(), found.all_counts()))
                    size += len(held[key][-1][0])
                if size >= HELD:
                    yield from emptied()
                    size = 0
        yield from emptied()

    return map_arrow(texts, run, BLOCKS)


def _narrow(counts: np.ndarray) -> bytes:
    """Counts in the fewest bytes that hold them; the width is the first byte."""
    width = next(w for w in (1, 2, 4, 8) if w == 8 or not len(counts) or counts.max() < 1 << (8 * w))
    return bytes([width]) + counts.astype(f"<u{width}").tobytes()


def _wide(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<u{data[0]}", offset=1).astype(np.int64)


def _frequent(batches):
    """The hashes of each (bucket, lang, shard) whose count reaches ``least``; rows come sorted by those."""
    schema = pa.schema([("hash", pa.int64())])

    def settled(key, parts):
        hashes, counts = summed(*(np.concatenate(x) for x in zip(*parts, strict=True)))
        return batch_of({"hash": hashes[counts >= key[-1]].view(np.int64)}, schema)

    last, parts = None, []
    for batch in batches:
        for *key, hashes, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if key != last and parts:
                yield settled(last, parts)
                parts = []
            last = key
            parts.append((np.frombuffer(hashes, np.uint64), _wide(counts)))
            if len(parts) >= 256:
                # What many tasks have in common is added up on the way.
                parts = [summed(*(np.concatenate(x) for x in zip(*parts, strict=True)))]
    if parts:
        yield settled(last, parts)


def frequent_somewhere(texts: DataFrame, support: int) -> DataFrame:
    """The hashes that reach some shard's own support."""
    totals = table(texts.groupBy("lang", "shard").agg(F.sum(F.regexp_count("text", F.lit(WORD))).alias("own")), "totals")
    whole = totals.groupBy("lang").agg(F.sum("own").alias("whole"))
    # own * support / whole, rounded up, in whole numbers.
    supports = totals.join(whole, "lang").where("whole > 0").selectExpr(
        "lang", "shard", f"cast((cast(own as decimal(20,0)) * {support} + whole - 1) div whole as bigint) as least")
    words = totals.agg(F.coalesce(F.sum("own"), F.lit(0))).first()[0]
    bucket_bits = int(3 * words // BUCKET).bit_length()
    blocks = local_counts(texts.join(small_side(supports, "supports"), ["lang", "shard"]), bucket_bits)
    order = ["bucket", "lang", "shard", "least"]
    dealt = blocks.repartition("bucket").sortWithinPartitions(*order).select(*order, "hashes", "counts")
    return map_arrow(dealt, _frequent, "hash long").distinct()


def bit_map(hashes: DataFrame, largest: int) -> tuple[np.ndarray, int]:
    """A map with about sixteen bits per hash, at most 2^``largest``; and the logarithm of its size.

    Blocks are filled by Spark; the driver joins at most 2^(``largest`` - 18) of them.
    """
    hashes = table(hashes, "frequent")
    bits = int(np.clip(int(16 * hashes.count()).bit_length(), BLOCK_BITS, largest))
    schema = pa.schema([("block", pa.int64()), ("bits", pa.binary())])
    low = (1 << BLOCK_BITS) - 1

    def fill(key, group):
        own = np.zeros(1 << BLOCK_BITS, np.uint8)
        own[group["place"].to_numpy() & low] = 1
        return pa.table({"block": [key[0].as_py()], "bits": [np.packbits(own, bitorder="little").tobytes()]}, schema=schema)

    place = F.shiftrightunsigned("hash", 64 - bits)
    blocks = hashes.select(place.alias("place")).distinct().withColumn("block", F.shiftright("place", BLOCK_BITS))
    whole = np.zeros((1 << bits) // 8, np.uint8)
    size = (1 << BLOCK_BITS) // 8
    for row in blocks.groupBy("block").applyInArrow(fill, "block long, bits binary").collect():
        whole[row.block * size:(row.block + 1) * size] = np.frombuffer(row.bits, np.uint8)
    return whole, bits


def global_counts(texts: DataFrame, whole: np.ndarray, bits: int, support: int) -> DataFrame:
    """(lang, phrase, size, n) of the phrases with global support, counted as text."""
    schema = pa.schema([("lang", pa.string()), ("phrase", pa.large_string()), ("size", pa.int32()), ("n", pa.int64())])
    shared = texts.sparkSession.sparkContext.broadcast(whole)

    def run(batches):
        bit_of = shared.value

        def marked(h: np.ndarray) -> np.ndarray:
            place = (h >> np.uint64(64 - bits)).astype(np.int64)
            return (bit_of[place >> 3] >> (place & 7).astype(np.uint8)) & 1

        for batch in batches:
            for part in pieces_of(batch, "text"):
                for (lang,), own in _by_group(part, ["lang"]):
                    phrases, sizes, counts = Phrases(own, _seed(lang)).texts_of(marked)
                    if len(counts):
                        yield batch_of({"lang": [lang] * len(counts), "phrase": phrases, "size": sizes, "n": counts}, schema)

    emitted = map_arrow(texts.drop("shard"), run, "lang string, phrase string, size int, n long")
    return emitted.groupBy("lang", "phrase", "size").agg(F.sum("n").alias("n")).where(F.col("n") >= support)


def frequent_phrases(docs: DataFrame, *, support: int = SUPPORT, shards: int = SHARDS, filter_bits: int = FILTER_BITS) -> DataFrame:
    """All phrases of one to three words with global support, and their exact counts."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), text.alias("text"),
                        F.pmod(F.xxhash64(F.col("doc_id"), text), F.lit(shards)).cast("int").alias("shard"))
    whole, bits = bit_map(frequent_somewhere(texts, support), filter_bits)
    return table(global_counts(texts, whole, bits, support), "phrases")


def score(a: str, left: str, right: str) -> Column:
    """floor(1000000 a^2 / (left right)) in whole numbers of up to 38 digits."""
    def wide(name: str) -> str:
        return f"cast({name} as decimal(16,0))"

    return F.expr(f"cast(1000000 as decimal(7,0)) * {wide(a)} * {wide(a)} div ({wide(left)} * {wide(right)})")


def scored(counts: DataFrame) -> DataFrame:
    """Every candidate with the parts of its lowest-scoring cut: lang, phrase, size, a, l, r, score."""
    word = F.split("phrase", " ", -1)
    candidates = counts.where("size > 1").withColumnRenamed("n", "a")

    def part(k: int, side: str, first: int, number: int) -> Column:
        return F.struct(F.lit(f"{side}{k}").alias("place"), F.array_join(F.slice("w", first, number), " ").alias("part"))

    parts = F.when(F.col("size") == 2, F.array(part(1, "l", 1, 1), part(1, "r", 2, 1))).otherwise(F.array(
        part(1, "l", 1, 1), part(1, "r", 2, 2), part(2, "l", 1, 2), part(2, "r", 3, 1)))
    asked = table(candidates.withColumn("w", word).select("lang", "phrase", "size", "a", F.explode(parts).alias("p")).select(
        "lang", "phrase", "size", "a", F.col("p.place").alias("place"), F.col("p.part").alias("part")), "parts")
    load = asked.groupBy("lang", "part").agg(F.count(F.lit(1)).alias("load"))
    known = table(counts.select("lang", F.col("phrase").alias("part"), "n").join(load, ["lang", "part"]), "known")
    found = weighted_join(asked, known, ["lang", "part"], "load", asked.count())
    wide = found.groupBy("lang", "phrase", "size", "a").agg(
        *[F.max(F.when(F.col("place") == p, F.col("n"))).alias(p) for p in ("l1", "r1", "l2", "r2")])
    cuts = wide.withColumn("s1", score("a", "l1", "r1")).withColumn("s2", F.when(F.col("size") == 3, score("a", "l2", "r2")))
    second = F.col("s2").isNotNull() & (F.col("s2") < F.col("s1"))
    return cuts.select("lang", "phrase", "size", "a", *[
        F.when(second, F.col(f"{c}2")).otherwise(F.col(f"{c}1")).alias(name)
        for c, name in (("l", "l"), ("r", "r"), ("s", "score"))])


def not_contained(candidates: DataFrame, share: int = SHARE) -> DataFrame:
    """Without the pairs of which a triple around them holds ``share`` in a hundred occurrences."""
    w = F.split("phrase", " ", -1)
    inner = F.array(F.array_join(F.slice(w, 1, 2), " "), F.array_join(F.slice(w, 2, 2), " "))
    around = candidates.where("size = 3").select("lang", F.col("a").alias("longer"), F.explode(inner).alias("phrase"))
    around = around.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    return candidates.join(around, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * share)).drop("longer")


def collocations(docs: DataFrame, *, support: int = SUPPORT, share: int = SHARE, first: int = FIRST,
                 shards: int = SHARDS, filter_bits: int = FILTER_BITS) -> DataFrame:
    """The ``first`` collocations of each language by score."""
    counts = frequent_phrases(docs, support=support, shards=shards, filter_bits=filter_bits)
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und"))
    words = F.regexp_count(F.coalesce(F.col("text").cast("string"), F.lit("")), F.lit(WORD))
    totals = docs.select(lang.alias("lang"), words.alias("n")).groupBy("lang").agg(F.sum("n").cast("long").alias("n"))
    kept = not_contained(table(scored(counts), "scored"), share)
    # First in each of a fixed number of parts, so that no task sees what all tasks kept.
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    parts = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(PARTS))).orderBy(*order)
    nearly = kept.withColumn("rank", F.row_number().over(parts)).where(F.col("rank") <= first)
    best = nearly.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= first)
    return best.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")

"""Tokens of two tokenizers aligned over the same bytes, and how well each pair of ids agrees.

Interval coalescing: all tokens of both tokenizers are byte ranges, sorted by start
(``lexsort``); a running maximum of their ends (``maximum.accumulate``) closes a group where
a token starts at it or after, so groups are the shortest stretches at whose ends tokens of
both end.  Within a group every A token is expanded to the B tokens whose ranges overlap its
own.  Those are the links.

The texts of one slice of a batch are laid one behind another on one axis of bytes, so a
whole slice is aligned by a few array operations; no group or link crosses texts, as both
tokenizers end at a text's end.

A pair's count is over the whole corpus.  Each text is tokenised once and written as one row
with its distinct id pairs; counts are one hash aggregation with map-side combining, at most
(ids of A) x (ids of B) rows; they come back to the rows in a join that broadcasts the fewer
than ten thousand pairs that are each in more than a ten-thousandth of the postings.

Defined results: texts null, empty, or that one of the tokenizers does not give back byte for
byte (space first) have no tokens: zeros and an empty checksum; repeated rows and rows with a
null id count each for itself; an empty table gives no rows.  Only doc_id and text are read.
A task holds the tokens of about ``SLICE`` bytes of text, or of one longer text.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlog.llm.common import map_arrow, pieces_of, table, weighted_join
from emberlog.llm.tokens import ByteIds, PieceIds

# Arrays of small slices stay in the processor's caches.
SLICE = 1 << 18
SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
                    ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("pairs", pa.list_(pa.int64())),
                    ("times", pa.list_(pa.int64()))])
SCHEMA_SQL = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
              "pairs array<long>, times array<long>")


def coalesced(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Group number of every A and every B token; both tile the same bytes from 0."""
    n = len(ends_a)
    ends = np.concatenate([ends_a, ends_b])
    starts = np.concatenate([ends_a[:-1], ends_b[:-1]])
    starts = np.insert(starts, [0, max(n - 1, 0)], 0)
    kind = np.repeat([0, 1], [n, len(ends_b)])
    order = np.lexsort((kind, starts))
    reach = np.maximum.accumulate(ends[order])
    opens = np.ones(len(order), bool)
    opens[1:] = starts[order][1:] >= reach[:-1]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(opens) - 1
    return group[:n], group[n:]


def links(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs (A token, B token) whose byte ranges overlap, by A token and B token."""
    starts_a, starts_b = (np.concatenate([[0], e[:-1]]) for e in (ends_a, ends_b))
    first = np.searchsorted(ends_b, starts_a, side="right")
    number = np.searchsorted(starts_b, ends_a, side="left") - first
    at_a = np.repeat(np.arange(len(ends_a)), number)
    within = np.arange(len(at_a)) - np.repeat(np.cumsum(number) - number, number)
    return at_a, first[at_a] + within


_NOTHING = np.zeros(0, np.int64)


class Flat:
    """Byte strings by number, joined by array operations."""

    def __init__(self, strings: list[bytes]):
        self.length = np.array([len(x) for x in strings], np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.data = np.frombuffer(b"".join(strings), np.uint8)

    def joined(self, numbers: np.ndarray) -> np.ndarray:
        length = self.length[numbers]
        ends = np.cumsum(length)
        return self.data[np.repeat(self.start[numbers] - (ends - length), length) + np.arange(ends[-1] if len(ends) else 0)]


class Aligner:
    """Aligns lists of texts; holds both vocabularies."""

    def __init__(self, byte_files: tuple[str | None, str | None] = (None, None), piece_file: str | None = None):
        self.a, self.b = ByteIds(*byte_files), PieceIds(piece_file)
        self.n_a, self.n_b = len(self.a.tokens), len(self.b.tokens)
        self.bytes_a, self.bytes_b = (Flat(x.tokens) for x in (self.a, self.b))
        # What each id is written as after no sign, a comma, a bar or a semicolon; A's ids, then B's.
        numbers = [str(i).encode() for i in (*range(self.n_a), *range(self.n_b))]
        self.written = Flat([sign + number for sign in (b"", b",", b"|", b";") for number in numbers])

    def tokens(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """Ids of A and B of each text; None where a text has no tokens."""
        spaced = [f" {t}" if t else "" for t in texts]
        sides = ([self.a.ids(t) if t else _NOTHING for t in spaced], self.b.ids([t or "" for t in texts]))
        raw = [t.encode() for t in spaced]
        sizes = np.array([len(r) for r in raw], np.int64)
        fits = sizes > 0
        for flat, side in zip((self.bytes_a, self.bytes_b), sides, strict=True):
            # Texts whose token bytes have another length differ anyway; the others are compared byte by byte.
            fits &= np.array([flat.length[ids].sum() for ids in side], np.int64) == sizes
            at = np.flatnonzero(fits)
            if len(at):
                same = flat.joined(np.concatenate([side[i] for i in at])) == np.frombuffer(b"".join(raw[i] for i in at), np.uint8)
                fits[at] = np.logical_and.reduceat(same, np.cumsum(sizes[at]) - sizes[at])
        return [(a, b) if ok else None for a, b, ok in zip(*sides, fits.tolist(), strict=True)]

    def align(self, texts: list[str | None]) -> list[tuple]:
        """(n_a, n_b, n_groups, n_links, checksum, pairs, times) of each text; a pair is A id * n_b + B id."""
        found = self.tokens(texts)
        whole = [own for own in found if own]
        results = iter(self._aligned(whole) if whole else ())
        nothing = (0, 0, 0, 0, "", [], [])
        return [next(results) if own else nothing for own in found]

    def _aligned(self, whole: list[tuple[np.ndarray, np.ndarray]]):
        count_a, count_b = (np.array([len(own[k]) for own in whole]) for k in (0, 1))
        a, b = (np.concatenate([own[k] for own in whole]) for k in (0, 1))
        doc_a, doc_b = (np.repeat(np.arange(len(whole)), n) for n in (count_a, count_b))
        ends_a, ends_b = np.cumsum(self.bytes_a.length[a]), np.cumsum(self.bytes_b.length[b])
        group_a, group_b = coalesced(ends_a, ends_b)
        at_a, at_b = links(ends_a, ends_b)
        documents = len(whole)
        n_links = np.bincount(doc_a[at_a], minlength=documents)
        opened = np.concatenate([[True], group_a[1:] != group_a[:-1]])
        n_groups = np.bincount(doc_a[opened], minlength=documents)
        spread = self.n_a * self.n_b
        keyed, times = np.unique(doc_a[at_a] * spread + a[at_a] * self.n_b + b[at_b], return_counts=True)
        cuts = np.searchsorted(keyed, np.arange(documents + 1) * spread)
        pairs = keyed % spread
        # The text form: groups in order, A's ids before B's.
        group, doc = np.concatenate([group_a, group_b]), np.concatenate([doc_a, doc_b])
        kind = np.repeat([0, 1], [len(a), len(b)])
        order = np.lexsort((kind, group))
        group, doc, kind = group[order], doc[order], kind[order]
        sign = np.zeros(len(order), np.int64)
        sign[1:] = np.where(doc[1:] != doc[:-1], 0, np.where(group[1:] != group[:-1], 3, np.where(kind[1:] != kind[:-1], 2, 1)))
        ids = np.concatenate([a, b + self.n_a])[order]
        marked = sign * (self.n_a + self.n_b) + ids
        written = self.written.joined(marked)
        stops = np.cumsum(self.written.length[marked])[np.cumsum(count_a + count_b) - 1].tolist()
        for i, (x, y) in enumerate(zip([0, *stops], stops, strict=False)):
            checksum = hashlib.sha256(written[x:y]).hexdigest()
            yield (int(count_a[i]), int(count_b[i]), int(n_groups[i]), int(n_links[i]), checksum,
                   pairs[cuts[i]:cuts[i + 1]], times[cuts[i]:cuts[i + 1]])


def aligned(docs: DataFrame, **files) -> DataFrame:
    """One row per document: counts, checksum of its groups, its distinct id pairs and their numbers."""

    def run(batches):
        aligner = None
        for batch in batches:
            aligner = aligner or Aligner(**files)
            for part in pieces_of(batch, "text", SLICE):
                rows = aligner.align(part["text"].to_pylist())
                columns = list(zip(*rows, strict=True)) if rows else [()] * 7
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], *(pa.array(c, f.type) for c, f in zip(columns, list(SCHEMA)[1:], strict=True))], schema=SCHEMA)

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_arrow(source, run, SCHEMA_SQL)


def pair_counts(postings: DataFrame, n_b: int) -> DataFrame:
    """Corpus-wide links of each pair, whether they are the most of its B id, and the rows that hold it.

    The most per B id are at most as many rows as B has ids, hence the broadcast.
    """
    counts = table(postings.groupBy("pair").agg(F.sum("times").alias("links"), F.count(F.lit(1)).alias("load")), "pairs")
    counts = counts.withColumn("b", F.col("pair") % n_b)
    most = counts.groupBy("b").agg(F.max("links").alias("most"))
    return counts.join(F.broadcast(most), "b").select("pair", "links", (F.col("links") == F.col("most")).alias("best"), "load")


def align_documents(docs: DataFrame, **files) -> DataFrame:
    """Per document: tokens, groups and links, links of best pairs, and the sum of pair counts.

    ``files``: ``byte_files`` (ranks, json) and ``piece_file``; default: the public vocabularies.
    """
    n_b = len(PieceIds(files.get("piece_file")).tokens)
    rows = table(aligned(docs, **files).withColumn("row", F.monotonically_increasing_id()), "aligned")
    postings = rows.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select(
        "row", F.col("p.pairs").alias("pair"), F.col("p.times").alias("times"))
    counts = table(pair_counts(postings, n_b), "counts")
    total = counts.agg(F.coalesce(F.sum("load"), F.lit(0))).first()[0]
    sums = weighted_join(postings, counts, ["pair"], "load", total).groupBy("row").agg(
        F.sum(F.col("times") * F.col("links")).alias("count_sum"),
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"))
    out = rows.drop("pairs", "times").join(sums, "row", "left")
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", F.lit(0)).alias("n_best"),
                      F.coalesce("count_sum", F.lit(0)).alias("count_sum"), "groups_sha256")

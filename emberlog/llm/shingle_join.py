"""Jaccard join on word shingles by rare-first prefix filtering, and its linked groups.

Two documents link when their sets of three-word shingles have a Jaccard similarity of at
least ``percent`` in a hundred; groups are the connected components.  The result is exact.

Rare-first order: shingle hashes are counted in 2**18 buckets over the corpus - a table of
fixed size - and ordered by their bucket's count, then by hash.  Two linked sets share one
of the first n - ceil(t n) + 1 shingles of that order, so only those prefixes are joined.

Equal sets are one node from the start.  Nodes that share a prefix shingle are screened by
the length, positional and suffix filters on narrow rows; the texts of those that pass
travel compressed to where they are verified, in two rounds:

1. every node under its two rarest shared shingles, crowded groups dealt to blocks that all
   hold the group's smallest node.  In a group a walk verifies each reached node against
   those not reached yet: a crowd of near copies costs a few sweeps instead of all pairs.
2. components that still meet under a shared shingle.  The members of the larger one, dealt
   to blocks, meet the nodes of others that share a shingle with them once, whatever number
   of shingles they share.  Smaller components that meet beside a larger one are compared
   too, once for each distinct set of nodes that some shingle brings together.  Pairs inside
   a component are not looked at again.

Defined results: null and empty texts, and those without a word, have no shingle and are a
component of their own; texts of one or two words have one shingle; repeated rows are equal
sets; rows that share an id are linked; rows with a null id are documents of their own.  Nodes
are numbered distinct sets, whatever ids they have, so null ids link nothing.  A component is
named by its least id; a null orders first among the ids, or last (``null_least``).  Only
doc_id and text are read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from emberlog.llm.common import batch_of, map_arrow, packed, pieces_of, table, unpacked
from emberlog.session import small_side

NO_ID = -(1 << 63)
BITS = 18
BUCKETS = 1 << BITS
HISTOGRAM = 64
BLOCK = 1024
# Hashing takes some twenty bytes of working memory for each byte of a chunk.
CHUNK = 1 << 20
# Shingles that a block of nodes holds about at most, beside its number of rows.
WEIGHT = 1 << 20

_U = np.uint64
_BASE = 0xD1342543DE82EF95 | 1
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_VALUE = np.random.default_rng(20240103).integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
_VALUE[ord("A"):ord("Z") + 1] = _VALUE[ord("a"):ord("z") + 1]
_FACTORS = [_U(0x9FB21C651E98DF25), _U(0xC2B2AE3D27D4EB4F), _U(0x165667B19E3779F9), _U(0x27D4EB2F165667C5), _U(0x85EBCA77C2B2AE63)]
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = max(CHUNK + (CHUNK >> 2), n) + 1
    if size not in _powers:
        _powers.clear()
        made = []
        for b in (_BASE, pow(_BASE, -1, 1 << 64)):
            p = np.full(size, b, _U)
            p[0] = 1
            made.append(np.multiply.accumulate(p))
        _powers[size] = made[0], made[1]
    return _powers[size]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> _U(29))) * _U(0xFF51AFD7ED558CCD)
    return x ^ (x >> _U(32))


def shingle_hashes(texts: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles of all texts in a row, and where each text's begin and end."""
    data = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
    begins = np.cumsum([0, *[len(t) + 1 for t in texts]])[:-1]
    inside = np.concatenate([[False], ~_SEPARATOR[data], [False]])
    turns = np.flatnonzero(inside[1:] != inside[:-1])
    first, stop = turns[::2], turns[1::2]
    up, down = _power_tables(len(data))
    sums = np.zeros(len(data) + 1, _U)
    np.cumsum(_VALUE[data] * up[: len(data)], out=sums[1:])
    words = _mixed((sums[stop] - sums[first]) * down[first] + (stop - first).astype(_U))
    edges = np.concatenate([np.searchsorted(first, begins), [len(words)]])
    counts = np.diff(edges)
    n = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    places = np.concatenate([[0], np.cumsum(n)])
    out = np.zeros(places[-1], _U)
    if len(words) >= size:
        rolled = np.zeros(len(words) - size + 1, _U)
        for k in range(size):
            rolled += words[k:len(words) - size + 1 + k] * _FACTORS[k]
        full = counts >= size
        take = np.repeat(edges[:-1][full] - places[:-1][full], n[full])
        at = np.concatenate([np.arange(a, b) for a, b in zip(places[:-1][full], places[1:][full], strict=True)]) if full.any() else np.zeros(0, np.int64)
        out[at] = rolled[at + take]
    for i in np.flatnonzero((counts > 0) & (counts < size)):
        own = words[edges[i]:edges[i + 1]]
        out[places[i]] = (own * np.array(_FACTORS[: len(own)])).sum(dtype=_U) + _U(len(own))
    return _mixed(out), places


def ordered_sets(texts: list[bytes], size: int, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text as numbers in rare-first order, and where each text's begin.

    A number is the bucket's rank followed by the hash's other bits: nothing is lost.
    """
    hashes, places = shingle_hashes(texts, size)
    numbers = (ranks[(hashes & _U(BUCKETS - 1)).astype(np.int64)] << _U(64 - BITS)) | (hashes >> _U(BITS))
    for a, b in zip(places[:-1].tolist(), places[1:].tolist(), strict=True):
        numbers[a:b].sort()
    new = np.ones(len(numbers), bool)
    new[1:] = numbers[1:] != numbers[:-1]
    new[places[:-1][places[:-1] < len(numbers)]] = True
    before = np.concatenate([[0], np.cumsum(new)])
    return numbers[new], before[places]


def bucket_ranks(docs: DataFrame, size: int) -> np.ndarray:
    """Rank of each bucket by how many shingles of the corpus fall in it; rarest first."""
    schema = pa.schema([("bucket", pa.int32()), ("n", pa.int64())])

    def run(batches):
        counts = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for part in pieces_of(batch, "text", CHUNK):
                hashes, _ = shingle_hashes([(t or "").encode() for t in part["text"].to_pylist()], size)
                counts += np.bincount((hashes & _U(BUCKETS - 1)).astype(np.int64), minlength=BUCKETS)
        own = np.flatnonzero(counts)
        yield batch_of({"bucket": own, "n": counts[own]}, schema)

    total = np.zeros(BUCKETS, np.int64)
    # BUCKETS rows at most.
    rows = map_arrow(docs, run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    total[rows["bucket"].to_numpy()] = rows["n"].to_numpy()
    ranks = np.empty(BUCKETS, _U)
    ranks[np.lexsort((np.arange(BUCKETS), total))] = np.arange(BUCKETS, dtype=_U)
    return ranks


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1 if n else 0


def histogram(numbers: np.ndarray) -> np.ndarray:
    """How many shingles of a set fall in each of 64 parts of the hash space, 255 at most.

    Counts cut at 255 are never further apart than the counts themselves, so the filter stays safe.
    """
    counts = np.bincount((numbers & _U(HISTOGRAM - 1)).astype(np.int64), minlength=HISTOGRAM)
    return np.minimum(counts, 255).astype(np.uint8)


def facts_of(docs: DataFrame, size: int, percent: int, ranks) -> DataFrame:
    """Per row: size of its set, the set's 128-bit key, its prefix, and its histogram over the hash space."""
    schema = pa.schema([("doc", pa.int64()), ("digest", pa.binary()), ("n", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("prefix", pa.binary()),
                        ("bins", pa.binary())])

    def run(batches):
        for batch in batches:
            for part in pieces_of(batch, "text", CHUNK):
                numbers, places = ordered_sets([(t or "").encode() for t in part["text"].to_pylist()], size, ranks.value)
                columns: dict[str, list] = {k: [] for k in ("n", "k1", "k2", "prefix", "bins")}
                for a, b in zip(places[:-1].tolist(), places[1:].tolist(), strict=True):
                    key = hashlib.blake2b(numbers[a:b].tobytes(), digest_size=16).digest()
                    columns["n"].append(b - a)
                    columns["k1"].append(int.from_bytes(key[:8], "little", signed=True))
                    columns["k2"].append(int.from_bytes(key[8:], "little", signed=True))
                    columns["prefix"].append(numbers[a:a + prefix_length(b - a, percent)].tobytes())
                    columns["bins"].append(histogram(numbers[a:b]).tobytes())
                yield batch_of({"doc": part["doc"], "digest": part["digest"], **columns}, schema)

    return map_arrow(docs, run, "doc long, digest binary, n long, k1 long, k2 long, prefix binary, bins binary")


def postings_of(classes: DataFrame) -> DataFrame:
    """A row per prefix shingle of each class: (token, doc, n, pos)."""
    schema = pa.schema([("token", pa.int64()), ("doc", pa.int64()), ("n", pa.int64()), ("pos", pa.int64())])

    def run(batches):
        for batch in batches:
            prefixes = [np.frombuffer(p, np.int64) for p in batch["prefix"].to_pylist()]
            lengths = np.array([len(p) for p in prefixes], np.int64)
            if not lengths.sum():
                continue
            starts = np.repeat(np.cumsum(lengths) - lengths, lengths)
            yield batch_of({
                "token": np.concatenate(prefixes), "doc": np.repeat(batch["doc"].to_numpy(), lengths),
                "n": np.repeat(batch["n"].to_numpy(), lengths), "pos": np.arange(lengths.sum()) - starts}, schema)

    return map_arrow(classes.select("doc", "n", "prefix"), run, "token long, doc long, n long, pos long")


def bodies_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(doc, body): compressed texts, a quarter of the size of their sets, of the wanted nodes.

    ``wanted``: doc, id and digest of one row of each node.
    """
    schema = pa.schema([("id", pa.int64()), ("digest", pa.binary()), ("body", pa.binary())])

    def run(batches):
        packer = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            for part in pieces_of(batch, "text", CHUNK):
                yield batch_of({"id": part["doc"], "digest": part["digest"], "body": [packer.compress((t or "").encode()) for t in part["text"].to_pylist()]}, schema)

    # Copies without an id are one row, lest they meet under one key.
    unnamed = docs.where("doc is null").groupBy("digest").agg(F.first("text").alias("text"))
    rows = docs.where("doc is not null").select("doc", "text", "digest").unionByName(
        unnamed.select(F.lit(NO_ID).alias("doc"), "text", "digest"))
    return map_arrow(rows, run, "id long, digest binary, body binary").join(
        wanted.hint("shuffle_hash"), ["id", "digest"]).select("doc", "body")


class Group:
    """Nodes that meet, with what the filters need."""

    def __init__(self, docs, positions, percent: int, bodies, size: int, ranks):
        self.docs = docs
        self.pos = np.zeros(len(docs), np.int64) if positions is None else np.asarray(positions, np.int64)
        self.percent = percent
        unpack = zstandard.ZstdDecompressor()
        self.items: list[np.ndarray] = []
        texts: list[bytes] = []
        held = 0
        # Texts in slices: hashing takes a multiple of their size.
        for k, body in enumerate(bodies, 1):
            texts.append(unpack.decompress(body))
            held += len(texts[-1])
            if held >= CHUNK or k == len(bodies):
                numbers, places = ordered_sets(texts, size, ranks)
                self.items += [numbers[a:b] for a, b in zip(places[:-1].tolist(), places[1:].tolist(), strict=True)]
                texts, held = [], 0
        self.n = np.array([len(i) for i in self.items], np.int64)
        self.bins = np.stack([histogram(i) for i in self.items]).astype(np.int16)

    def candidates(self, i: int, others: np.ndarray) -> np.ndarray:
        """Those of ``others`` that pass the length, positional and suffix filters."""
        return others[possible(self.n[i], self.n[others], self.pos[i], self.pos[others], self.bins[i], self.bins[others], self.percent)]

    def linked(self, i: int, others: np.ndarray) -> np.ndarray:
        """Those of ``others`` that link with ``i``: exact."""
        if not len(others):
            return others
        own = self.items[i]
        flat = np.concatenate([self.items[j] for j in others])
        hit = own[np.minimum(np.searchsorted(own, flat), len(own) - 1)] == flat
        common = np.add.reduceat(hit.astype(np.int64), np.cumsum(self.n[others]) - self.n[others])
        return others[100 * common >= self.percent * (self.n[i] + self.n[others] - common)]


def walk(group: Group) -> list[tuple[int, int]]:
    """Edges that connect what is linked inside the group."""
    edges, left = [], np.arange(len(group.docs))
    while len(left):
        seed, left = left[0], left[1:]
        queue = [seed]
        while queue and len(left):
            i = queue.pop()
            found = group.linked(i, group.candidates(i, left))
            if len(found):
                edges += [(int(group.docs[i]), int(group.docs[j])) for j in found]
                queue += found.tolist()
                left = left[~np.isin(left, found)]
    return edges


def cross(group: Group, comps: np.ndarray, side: np.ndarray) -> list[tuple[int, int]]:
    """Edges between components: from members of side 1 to those of side 2 (or 1, if 2 is absent)."""
    edges = []
    comps = comps.copy()
    one = np.flatnonzero(side == 1)
    two = np.flatnonzero(side == 2)
    within = not len(two)
    for k, i in enumerate(one):
        others = one[k + 1:] if within else two
        others = others[comps[others] != comps[i]]
        others = group.candidates(i, others)
        # A few at a time: the first link may make the rest needless.
        step = 16
        while len(others):
            found = group.linked(i, others[:step])
            others = others[step:]
            for j in found:
                if comps[j] != comps[i]:
                    edges.append((int(group.docs[i]), int(group.docs[j])))
                    comps[comps == comps[j]] = comps[i]
            if len(found):
                others = others[comps[others] != comps[i]]
            step *= 2
    return edges


EDGES = pa.schema([("u", pa.int64()), ("v", pa.int64())])


def _by_group(batches, keys: tuple[str, ...]):
    """Whole groups of consecutive rows with equal keys."""
    held = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        held = rows if held is None else pa.concat_tables([held, rows])
        marks = [held[k].to_numpy() for k in keys]
        new = np.flatnonzero(np.any([m[1:] != m[:-1] for m in marks], axis=0)) + 1
        cuts = [0, *new.tolist()]
        for a, b in zip(cuts, cuts[1:], strict=False):
            yield held.slice(a, b - a)
        held = held.slice(cuts[-1])
    if held is not None and held.num_rows:
        yield held


def _edge_batch(edges):
    return batch_of({"u": [e[0] for e in edges], "v": [e[1] for e in edges]}, EDGES)


def possible(n, m, p, q, bins, others, percent: int) -> np.ndarray:
    """Which pairs pass the length, positional and suffix filters; all arguments by pair."""
    need = -(-percent * (n + m) // (100 + percent))
    fits = 100 * np.minimum(n, m) >= percent * np.maximum(n, m)
    # Shared before the common shingle at most the smaller position, then what follows.
    fits &= np.minimum(p, q) + np.minimum(n - p, m - q) >= need
    # Sets whose histograms are far apart cannot share enough.
    return fits & ((n + m - np.abs(bins - others).sum(axis=1)) // 2 >= need)


SMALL_GROUP = 8


def _screener(percent: int):
    """Rows of a shingle that some other row of it could link with, by the narrow filters."""
    schema = pa.schema([("token", pa.int64()), ("doc", pa.int64()), ("n", pa.int64()), ("pos", pa.int64())])

    def settle(rows: pa.Table) -> pa.Table:
        token, n, pos = (rows[c].to_numpy() for c in ("token", "n", "pos"))
        bins = np.frombuffer(b"".join(rows["bins"].to_pylist()), np.uint8).reshape(len(n), HISTOGRAM).astype(np.int16)
        starts = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
        sizes = np.diff(np.concatenate([starts, [len(token)]]))
        good = np.zeros(len(n), bool)
        # Small groups of one size together.
        for g in range(2, SMALL_GROUP + 1):
            own = starts[sizes == g]
            for i in range(g):
                for j in range(i + 1, g):
                    x, y = own + i, own + j
                    fits = possible(n[x], n[y], pos[x], pos[y], bins[x], bins[y], percent)
                    good[x[fits]] = True
                    good[y[fits]] = True
        for start, g in zip(starts[sizes > SMALL_GROUP].tolist(), sizes[sizes > SMALL_GROUP].tolist(), strict=True):
            for i in range(start, start + g - 1):
                # Once a row and all after it are known to stay, nothing is left to learn.
                if good[i:start + g].all():
                    break
                y = np.arange(i + 1, start + g)
                fits = possible(n[i], n[y], pos[i], pos[y], bins[i], bins[y], percent)
                good[y[fits]] = True
                good[i] |= bool(fits.any())
        return rows.select(schema.names).filter(pa.array(good)).cast(schema)

    def run(batches):
        for rows in _whole_groups(batches, ("token",), 20_000):
            yield from settle(rows).combine_chunks().to_batches()

    return run


def _whole_groups(batches, keys: tuple[str, ...], least: int):
    """Tables of about ``least`` rows that hold whole groups of consecutive rows with equal keys."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size < least:
            continue
        rows = pa.Table.from_batches(held)
        same = np.all([rows[k].to_numpy() == rows[k][-1].as_py() for k in keys], axis=0)
        cut = len(same) - int(np.argmin(same[::-1])) if not same.all() else 0
        if cut:
            yield rows.slice(0, cut)
            rows = rows.slice(cut)
        held, size = rows.to_batches(), rows.num_rows
    if size:
        yield pa.Table.from_batches(held)


PRINT = 256


def prints_of(bodies: DataFrame, size: int, ranks) -> DataFrame:
    """(doc, n, bins): sizes and fine histograms of the sets of compressed texts."""
    schema = pa.schema([("doc", pa.int64()), ("n", pa.int64()), ("bins", pa.binary())])

    def run(batches):
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            docs, bodies = batch["doc"].to_pylist(), batch["body"].to_pylist()
            # One text at a time bounds memory; the fixed cost is small beside a text's.
            out = []
            for body in bodies:
                numbers, _ = ordered_sets([unpack.decompress(body)], size, ranks.value)
                out.append((len(numbers), np.bincount((numbers & _U(PRINT - 1)).astype(np.int64), minlength=PRINT).astype(np.int32).tobytes()))
            yield batch_of({"doc": docs, "n": [o[0] for o in out], "bins": [o[1] for o in out]}, schema)

    return map_arrow(bodies, run, "doc long, n long, bins binary")


MEETING = "key long, part long, doc long, comp long, side int"


def _unit_screener(percent: int):
    """Rows of a unit that some row of another component could link with, by size and fine histogram."""
    schema = pa.schema([("key", pa.int64()), ("part", pa.int64()), ("doc", pa.int64()), ("comp", pa.int64()), ("side", pa.int32())])

    def run(batches):
        for rows in _by_group(batches, ("key", "part")):
            n, comp, side = (rows[c].to_numpy() for c in ("n", "comp", "side"))
            bins = np.frombuffer(b"".join(rows["bins"].to_pylist()), np.int32).reshape(len(n), PRINT)
            one, two = np.flatnonzero(side == 1), np.flatnonzero(side == 2)
            good = np.zeros(len(n), bool)
            for k, i in enumerate(one):
                y = two if len(two) else one[k + 1:]
                y = y[comp[y] != comp[i]]
                fits = possible(n[i], n[y], 0, 0, bins[i], bins[y], percent)
                good[y[fits]] = True
                good[i] |= bool(fits.any())
            if good.any():
                kept = rows.select(schema.names).filter(pa.array(good)).cast(schema)
                yield from kept.combine_chunks().to_batches()

    return run


def _walker(percent: int, size: int, ranks):
    def run(batches):
        edges: list[tuple[int, int]] = []
        for rows in _by_group(batches, ("token", "block")):
            if rows.num_rows > 1:
                edges += walk(Group(rows["doc"].to_numpy(), rows["pos"].to_numpy(), percent, rows["body"].to_pylist(),
                                    size, ranks.value))
            if len(edges) > 10_000:
                yield _edge_batch(edges)
                edges = []
        yield _edge_batch(edges)

    return run


def _crosser(percent: int, size: int, ranks):
    def run(batches):
        edges: list[tuple[int, int]] = []
        for rows in _by_group(batches, ("key", "part")):
            if rows.num_rows > 1:
                group = Group(rows["doc"].to_numpy(), None, percent, rows["body"].to_pylist(), size, ranks.value)
                edges += cross(group, rows["comp"].to_numpy(), rows["side"].to_numpy())
            if len(edges) > 10_000:
                yield _edge_batch(edges)
                edges = []
        yield _edge_batch(edges)

    return run


def components(edges: DataFrame) -> DataFrame:
    """(node, comp): the least node reachable, for every node of an edge.

    Each round takes the least label among a node's neighbours and then the label's own
    label, which halves the remaining distance; rounds stop when no label changes.
    """
    both = table(edges.where("u <> v").select("u", "v").union(edges.where("u <> v").select("v", "u")).distinct(), "edges")
    labels = table(both.groupBy(F.col("u").alias("node")).agg(F.least(F.min("v"), F.min("u")).alias("comp")), "labels")
    while True:
        best = both.join(labels, both["v"] == labels["node"]).groupBy("u").agg(F.min("comp").alias("near"))
        nearer = labels.join(best, labels["node"] == best["u"]).select("node", F.least("comp", "near").alias("comp"), F.col("comp").alias("was"))
        jump = labels.select(F.col("node").alias("at"), F.col("comp").alias("further"))
        after = table(nearer.join(jump, nearer["comp"] == jump["at"], "left").select(
            "node", F.least("comp", F.coalesce("further", "comp")).alias("comp"), "was"), "labels")
        labels = after.select("node", "comp")
        if not after.where("comp <> was").limit(1).count():
            return labels


def blocks_of(rows, weight, block: int):
    """How many blocks hold ``rows`` nodes of ``weight`` shingles, about ``block`` nodes and WEIGHT shingles each."""
    return F.ceil(F.greatest(rows / block, weight / WEIGHT, F.lit(1.0))).cast("int")


def first_round(shared: DataFrame, bodies: DataFrame, block: int, run) -> DataFrame:
    """Edges inside the groups of every node's two rarest shared shingles."""
    rarest = Window.partitionBy("doc").orderBy("pos")
    own = shared.withColumn("_k", F.row_number().over(rarest)).where("_k <= 2").drop("_k")
    crowd = own.groupBy("token").agg(F.count(F.lit(1)).alias("members"), F.min("doc").alias("least"), F.sum("n").alias("_w")).where(
        "members > 1").select("token", "least", blocks_of(F.col("members"), F.col("_w"), block).alias("blocks"))
    dealt = own.join(crowd, "token").withColumn("block", F.when(
        F.col("doc") == F.col("least"), F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(
        F.array(F.pmod(F.xxhash64("doc"), F.col("blocks")).cast("int"))))
    rows = dealt.select("token", "doc", "pos", F.explode("block").alias("block")).join(bodies, "doc")
    grouped = rows.select("token", "block", "doc", "pos", "body").repartition("token", "block").sortWithinPartitions("token", "block", "doc")
    return map_arrow(grouped, run, "u long, v long")


def second_round(shared: DataFrame, comps: DataFrame, bodies: DataFrame, prints: DataFrame, percent: int, block: int,
                 screen, run) -> DataFrame:
    """Edges between components that still meet under a shared shingle."""
    weighed = comps.join(prints.select(F.col("doc").alias("node"), "n").groupBy("node").agg(F.max("n").alias("n")), "node", "left")
    sizes = weighed.groupBy("comp").agg(F.count(F.lit(1)).alias("total"), F.sum(F.coalesce("n", F.lit(0))).alias("_w"))
    labels = comps.join(sizes, "comp").select("node", "comp", "total", F.pmod(
        F.xxhash64("node"), blocks_of(F.col("total"), F.col("_w"), block)).cast("int").alias("own"))
    known = shared.join(labels, shared["doc"] == labels["node"], "left").select(
        "token", "doc", "n", "pos", F.coalesce("comp", "doc").alias("comp"), F.coalesce("own", F.lit(0)).alias("own"),
        F.coalesce("total", F.lit(1)).alias("total"))
    per_comp = known.groupBy("token", "comp").agg(
        F.count(F.lit(1)).alias("size"), F.max("total").alias("total"), F.sum("n").alias("weight"))
    # The host of a shingle: of the components that meet there, the largest.
    mixed = per_comp.groupBy("token").agg(
        F.count(F.lit(1)).alias("comps"), F.max(F.struct("total", "comp", "size", "weight")).alias("most"),
        F.sum("size").alias("members"), F.sum("weight").alias("weights")
    ).where("comps > 1").select("token", F.col("most.comp").alias("large"), "comps",
                                blocks_of(F.col("members") - F.col("most.size"), F.col("weights") - F.col("most.weight"), block).alias("few"))
    rows = table(known.join(mixed, "token"), "meeting")
    small = rows.where("comp <> large")
    # The largest component of a shingle in blocks, with the range of its sizes, and who meets it.
    large = rows.where("comp = large").groupBy("token", "comp", "own").agg(F.min("n").alias("low"), F.max("n").alias("high"))
    near = (100 * F.col("n") >= percent * F.col("low")) & (percent * F.col("n") <= 100 * F.col("high"))
    meets = table(large.join(small.select("token", F.col("doc").alias("guest"), F.col("comp").alias("home"), "n"), "token").where(near)
                  .select("comp", "own", "guest", "home", "n").distinct(), "guests")
    # Guests of a block are dealt to blocks too, each of which meets all hosts of the block.
    crowds = meets.groupBy("comp", "own").agg(F.count(F.lit(1)).alias("_g"), F.sum("n").alias("_w")).select(
        "comp", "own", blocks_of(F.col("_g"), F.col("_w"), block).alias("tables"))
    hosts = crowds.join(rows.select("doc", "comp", "own").union(labels.select("node", "comp", "own")).distinct(), ["comp", "own"])
    place = lambda t: (F.col("own").cast("long") * (1 << 31) + t).alias("part")
    units = hosts.withColumn("_t", F.explode(F.sequence(F.lit(0), F.col("tables") - 1))).select(
        F.col("comp").alias("key"), place(F.col("_t")), "doc", "comp", F.lit(2).alias("side"))
    units = units.unionByName(meets.join(crowds, ["comp", "own"]).select(
        F.col("comp").alias("key"), place(F.pmod(F.xxhash64("guest"), F.col("tables"))),
        F.col("guest").alias("doc"), F.col("home").alias("comp"), F.lit(1).alias("side")))
    # Smaller components among themselves: blocks a <= b of a shingle's nodes, each set of
    # nodes once.  A set holds two blocks at most.
    spread = small.where("comps > 2").withColumn("own", F.pmod(F.xxhash64("doc"), F.col("few")).cast("int")).select(
        "token", "doc", "comp", "own", F.explode(F.sequence(F.lit(0), F.col("few") - 1)).alias("other")).select(
        "token", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), "doc", "comp",
        F.when(F.col("own") <= F.col("other"), 1).otherwise(2).alias("side"))
    together = spread.groupBy("token", "a", "b").agg(F.sort_array(F.collect_set(F.struct("doc", "comp", "side"))).alias("nodes")).where(
        F.size(F.array_distinct("nodes.comp")) > 1)
    sets = together.select(F.xxhash64("nodes").alias("key"), F.xxhash64(F.lit(1), "nodes").alias("part"), "nodes").groupBy(
        "key", "part").agg(F.first("nodes").alias("nodes"))
    beside = sets.select("key", "part", F.explode("nodes").alias("x")).select("key", "part", "x.*")
    edges = []
    for meeting in (units, beside):
        # Fine histograms are much smaller than texts: only what passes them needs its text.
        sketched = meeting.join(prints, "doc").repartition("key", "part").sortWithinPartitions("key", "part", "doc")
        meeting = table(map_arrow(sketched.select("key", "part", "doc", "comp", F.col("side").cast("int").alias("side"), "n", "bins"),
                                  screen, MEETING), "units")
        placed = meeting.join(bodies, "doc").repartition("key", "part").sortWithinPartitions("key", "part", "doc")
        edges.append(map_arrow(placed.select("key", "part", "doc", "comp", "side", "body"), run, "u long, v long"))
    return edges[0].unionByName(edges[1])


def digest_of(text) -> object:
    """128 bits that stand for a text; null is the empty one."""
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def same_id(facts: DataFrame, classes: DataFrame) -> DataFrame | None:
    """Edges between the sets of rows that share an id; absent if no id has two sets."""
    key = F.struct("k1", "k2")
    named = facts.where("n > 0 and doc is not null")
    split = table(named.groupBy("doc").agg(F.min(key).alias("a"), F.max(key).alias("b")).where("a <> b").select("doc", "a"), "split")
    if not split.limit(1).count():
        return None
    pairs = named.select("doc", "k1", "k2").join(split, "doc").where("struct(k1, k2) <> a").select(
        "k1", "k2", F.col("a.k1").alias("_k1"), F.col("a.k2").alias("_k2")).distinct()
    first = classes.select(F.col("k1").alias("_k1"), F.col("k2").alias("_k2"), F.col("doc").alias("v"))
    return pairs.join(classes.select("k1", "k2", F.col("doc").alias("u")), ["k1", "k2"]).join(first, ["_k1", "_k2"]).select("u", "v")


def linked(docs: DataFrame, size: int, percent: int, block: int) -> DataFrame:
    """(doc, digest, n, comp, least, unnamed, heir) of every row.

    ``comp`` is the component (null without a shingle), ``least`` its least id, ``unnamed``
    whether it has rows without an id, ``heir`` the least digest of those.
    """
    spark = docs.sparkSession
    text = F.col("text").cast("string")
    source = docs.select(F.col("doc_id").cast("long").alias("doc"), text.alias("text"), digest_of(text).alias("digest"))
    ranks = spark.sparkContext.broadcast(bucket_ranks(source, size))  # BUCKETS numbers
    facts = table(facts_of(source, size, percent, ranks), "facts")
    keys = ["k1", "k2"]
    # One row of each set lends its text; nodes are numbers of their own, as ids may be null or shared.
    classes = table(facts.where("n > 0").groupBy(*keys).agg(
        F.min(F.struct(F.coalesce("doc", F.lit(NO_ID)).alias("id"), "digest")).alias("row"), F.min("doc").alias("least"),
        F.min(F.when(F.col("doc").isNull(), F.col("digest"))).alias("heir"), F.first("n").alias("n"),
        F.first("prefix").alias("prefix"), F.first("bins").alias("bins")).withColumn("doc", F.monotonically_increasing_id()), "classes")
    postings = postings_of(classes)
    # Postings travel once: the number of rows of a shingle is counted where they meet.
    known = postings.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy("token"))).where("_n > 1")
    # Crowds beyond a block are not screened, as that would grow with their square, nor gathered.
    crowds = known.where(F.col("_n") > block).select("token", "doc", "n", "pos")
    met = known.where(F.col("_n") <= block).drop("_n").join(classes.select("doc", "bins"), "doc")
    screened = met.repartition("token").sortWithinPartitions("token", "doc")
    shared = table(map_arrow(screened.select("token", "doc", "n", "pos", "bins"), _screener(percent),
                             "token long, doc long, n long, pos long").unionByName(crowds), "shared")
    wanted = shared.select("doc").distinct().join(classes.select("doc", "row.id", "row.digest"), "doc")
    bodies = table(bodies_of(source, wanted), "bodies")
    edges = table(first_round(shared, bodies, block, _walker(percent, size, ranks)), "edges1")
    comps = components(edges)
    prints = table(prints_of(bodies, size, ranks), "prints")
    more = table(second_round(shared, comps, bodies, prints, percent, block, _unit_screener(percent),
                              _crosser(percent, size, ranks)), "edges2")
    known = same_id(facts, classes)
    every = edges.unionByName(more) if known is None else edges.unionByName(more).unionByName(known)
    if known is not None or more.limit(1).count():
        comps = components(every)
    # A set outside all components names itself; the others take their component's names.
    joint = comps.join(classes.select(F.col("doc").alias("node"), "least", "heir"), "node").groupBy("comp").agg(
        F.min("least").alias("_least"), F.min("heir").alias("_heir"))
    labels = comps.join(joint, "comp")
    within = lambda ours, own: F.when(F.col("node").isNotNull(), F.col(ours)).otherwise(F.col(own)).alias(own)
    named = classes.join(labels, classes["doc"] == labels["node"], "left").select(
        *keys, F.coalesce("comp", "doc").alias("comp"), within("_least", "least"), within("_heir", "heir"))
    return facts.select("doc", "digest", "n", *keys).join(named, keys, "left").select(
        "doc", "digest", "n", "comp", "least", F.col("heir").isNotNull().alias("unnamed"), "heir")


def similar_groups(docs: DataFrame, *, size: int = 3, percent: int = 90, block: int = BLOCK, null_least: bool = True) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row.

    A component with rows without an id is named null, or by its least id where
    ``null_least`` is false; it is null then only if no row of it has an id.
    """
    rows = linked(docs, size, percent, block)
    name = F.when(~F.col("unnamed"), F.col("least")) if null_least else F.col("least")
    return rows.select(F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"),
                       F.when(F.col("n") > 0, name).otherwise(F.col("doc")).alias("component_id"))


def one_of_each(docs: DataFrame, *, size: int = 3, percent: int = 90, block: int = BLOCK) -> DataFrame:
    """The documents without near duplicates: the smallest id of each group stays.

    Rows that repeat an id are one document and stay or go together; of a group without any
    id one row stays; documents without a shingle all stay.
    """
    rows = table(linked(docs, size, percent, block), "linked")
    whole = packed(docs, id=F.col("doc_id").cast("long"), text=F.col("text").cast("string"))
    # Texts need no shuffle where the documents that go are few enough to be sent to all tasks.
    extra = small_side(rows.where("n > 0 and doc <> least").select(F.col("doc").alias("id")).distinct(), "gone")
    stay = whole.where("id is not null").join(extra, "id", "left_anti")
    unnamed = rows.where("doc is null and (n = 0 or (least is null and digest = heir))").select(
        "digest", (F.col("n") > 0).alias("one")).distinct()
    if not unnamed.limit(1).count():
        return unpacked(stay, docs)
    alone = whole.where("id is null").withColumn("digest", digest_of(F.col("text"))).join(unnamed, "digest")
    one = alone.where("one").dropDuplicates(["digest"])
    return unpacked(stay.select("doc").unionByName(one.select("doc")).unionByName(alone.where("not one").select("doc")), docs)

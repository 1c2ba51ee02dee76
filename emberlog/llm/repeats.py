"""Removal of repeated byte strings with a sparse suffix array and deep-shallow sorting.

A byte goes if it lies in a string of ``length`` bytes (100) that also starts earlier: in a
document with a smaller id, or earlier in the same one.  The result is exact.

Which suffixes to sort.  Every window of 100 bytes names one anchor, the position of its
least k-gram hash.  Equal windows name it at the same place, so only windows of anchors with
equal hashes can be equal.  Consecutive windows with one anchor form a run; an anchor whose
hash is unique in the corpus is dropped at once, and runs with equal bytes are settled by
their checksum: the first stays.  What is left are the first runs of anchors that occur with
different surroundings.

Sorting them.  The suffixes from each anchor on, and the reversed prefixes before it, are
ordered within their anchor by deep-shallow sorting: multikey quicksort by eight-byte
symbols to a shallow depth, then a blind trie for each group that still shares its prefix.
Two windows at distance d from their anchors are equal if and only if the suffixes share
100 - d bytes and the prefixes d bytes, which the longest common prefixes of neighbours in
the two orders say.

Skew: equal runs are merged inside each task before the shuffle, so a passage in a third of
all documents leaves a row per four megabytes.  An anchor with more than ``group_limit`` runs
is not sorted in one task; its windows are compared by 128-bit hashes spread over all tasks
instead, with the same result.

Defined results: null and empty texts, and those shorter than a window, lose nothing; rows
that repeat both id and text are one document and get the same result each; different texts
under one id are told apart by 64 bits of a hash and ordered by them; a null id orders first.
Only doc_id and text are read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from emberlog.llm.common import CHUNK_BYTES, batch_of, map_arrow, pieces_of, table

LENGTH = 100
GRAM = 20
WIDTH = LENGTH - GRAM + 1
SHALLOW = 5  # eight-byte symbols
NO_ID = -(1 << 63)

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_TABLE = np.random.default_rng(20240101).integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
_TABLE2 = np.random.default_rng(20240102).integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    size = max(CHUNK_BYTES + LENGTH, n) + 1
    if size not in _powers:
        _powers.clear()
        made = []
        for b in (_BASE, pow(_BASE, -1, 1 << 64)):
            p = np.full(size, b, _U)
            p[0] = 1
            made.append(np.multiply.accumulate(p))
        _powers[size] = made[0], made[1]
    return _powers[size]


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(31))) * _U(0x7FB5D329728EA185)
    x = (x ^ (x >> _U(27))) * _U(0x81DADEF4BC2DD44D)
    return x ^ (x >> _U(33))


def runs_of(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of windows with one anchor: anchor hash, run checksum, first and last window, anchor.

    ``ends``: where each text in ``data`` ends; windows do not cross texts.
    """
    n = len(data)
    none = np.zeros(0, np.int64)
    if n < LENGTH:
        return none.view(_U), none.view(_U), none, none, none
    up, down = powers(n)
    sums = np.zeros(n + 1, _U)
    np.cumsum(_TABLE[data] * up[:n], out=sums[1:])
    grams = mixed((sums[GRAM:] - sums[:-GRAM]) * down[: n - GRAM + 1])
    # Sliding minimum by doubling; the place in the low bits makes the leftmost win.
    low = (grams & _U(0xFFFFFFFFFF000000)) | np.arange(len(grams), dtype=_U)
    span = 1
    while span * 2 <= WIDTH:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    if span < WIDTH:
        low = np.minimum(low[: len(low) - (WIDTH - span)], low[WIDTH - span:])
    edges = np.zeros(n + 1, np.int32)
    starts = np.concatenate([[0], ends[:-1]])
    long = ends - starts >= LENGTH
    np.add.at(edges, starts[long], 1)
    np.add.at(edges, ends[long] - LENGTH + 1, -1)
    windows = np.flatnonzero(np.cumsum(edges)[: len(low)] > 0)
    if not len(windows):
        return none.view(_U), none.view(_U), none, none, none
    anchors = (low[windows] & _U(0xFFFFFF)).astype(np.int64)
    breaks = np.flatnonzero((np.diff(anchors) != 0) | (np.diff(windows) != 1)) + 1
    first = windows[np.concatenate([[0], breaks])]
    last = windows[np.concatenate([breaks, [len(windows)]]) - 1]
    at = anchors[np.concatenate([[0], breaks])]
    shape = ((at - first).astype(_U) << _U(8)) | (last - first).astype(_U)
    check = mixed(mixed((sums[last + LENGTH] - sums[first]) * down[first]) ^ shape)
    return grams[at], check, first, last, at


def text_tag(text: bytes) -> int:
    """Tells apart different texts stored under one id, or without an id."""
    return int.from_bytes(hashlib.blake2b(text, digest_size=8).digest(), "little", signed=True)


def packed_place(start, count, offset):
    """First window, number of windows, and the anchor's distance from the first, in one number."""
    return (start << 14) | (count << 7) | offset


def unpacked(place: np.ndarray) -> tuple[np.ndarray, ...]:
    """Anchor, first window, number of windows, and the anchor's distance from the first."""
    start, offset = place >> 14, place & 0x7F
    return start + offset, start, (place >> 7) & 0x7F, offset


RUNS = pa.schema([("a", pa.int64()), ("settled", pa.bool_()), ("c", pa.int64()), ("doc", pa.int64()), ("tag", pa.int64()),
                  ("place", pa.int64()), ("copied", pa.bool_())])


def _runs(batches):
    for batch in batches:
        for part in pieces_of(batch, "text"):
            texts = [(t or "").encode() for t in part["text"].to_pylist()]
            docs = part["doc"].to_pylist()
            pending, size = [], 0
            for i, text in enumerate(texts):
                if len(text) < LENGTH:
                    continue
                tag = text_tag(text)
                # Long texts in slices that share all but one byte of a window.
                for base in range(0, len(text) - LENGTH + 1, CHUNK_BYTES):
                    piece = text[base:base + CHUNK_BYTES + LENGTH - 1]
                    if pending and size + len(piece) > CHUNK_BYTES:
                        yield _chunk_runs(pending)
                        pending, size = [], 0
                    pending.append((docs[i], tag, base, piece))
                    size += len(piece)
            if pending:
                yield _chunk_runs(pending)


def _chunk_runs(pieces: list[tuple[int, int, int, bytes]]) -> pa.RecordBatch:
    """Runs of some texts; equal ones are merged, the first kept with the places of the rest."""
    ends = np.cumsum([len(p[3]) for p in pieces])
    a, c, first, last, at = runs_of(np.frombuffer(b"".join(p[3] for p in pieces), np.uint8), ends)
    own = np.searchsorted(ends, first, side="right")
    base = np.array([p[2] for p in pieces], np.int64) - np.concatenate([[0], ends[:-1]])
    docs = np.array([p[0] for p in pieces], np.int64)[own]
    tags = np.array([p[1] for p in pieces], np.int64)[own]
    place = packed_place(first + base[own], last - first + 1, at - first)
    a, c = a.view(np.int64), c.view(np.int64)
    order = np.lexsort((place, tags, docs, c, a))
    a, c, docs, tags, place = a[order], c[order], docs[order], tags[order], place[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (c[1:] != c[:-1])
    same_row = np.zeros(len(a), bool)
    same_row[1:] = ~new[1:] & (docs[1:] == docs[:-1]) & (tags[1:] == tags[:-1]) & (place[1:] == place[:-1])
    heads = np.flatnonzero(new)
    rest = np.flatnonzero(~new & ~same_row)
    copied = np.zeros(len(heads), bool)
    copied[np.cumsum(new)[rest] - 1] = True
    # Settled rows need no partner; a key of their own spreads them evenly.
    own_key = mixed((docs[rest].view(_U) * _U(31) + tags[rest].view(_U)) * _U(31) + place[rest].view(_U)).view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(x) for x in (
        np.concatenate([a[heads], own_key]), np.arange(len(heads) + len(rest)) >= len(heads),
        np.concatenate([c[heads], np.zeros(len(rest), np.int64)]), np.concatenate([docs[heads], docs[rest]]),
        np.concatenate([tags[heads], tags[rest]]), np.concatenate([place[heads], place[rest]]), np.concatenate([copied, np.zeros(len(rest), bool)]))], schema=RUNS)


def lcp(s: bytes, t: bytes) -> int:
    """Length of the longest common prefix."""
    n = min(len(s), len(t))
    if s[:n] == t[:n]:
        return n
    low, high = 0, n
    while high - low > 1:
        middle = (low + high) // 2
        if s[low:middle] == t[low:middle]:
            low = middle
        else:
            high = middle
    return low


def blind_trie_order(strings: list[bytes]) -> list[int]:
    """Sorted order of the strings by a trie that stores branching depths only.

    A search follows the branching bytes without looking at what lies between; one
    comparison with the leaf it ends at tells where the string really parts.
    """
    def byte(s: bytes, d: int) -> int:
        return s[d] if d < len(s) else -1

    root: object = 0
    equal: dict[int, list[int]] = {0: [0]}
    for i in range(1, len(strings)):
        s, node = strings[i], root
        while type(node) is tuple:
            depth, children = node
            following = children.get(byte(s, depth))
            node = next(iter(children.values())) if following is None else following
        other = strings[node]
        if s == other:
            equal[node].append(i)
            continue
        equal[i] = [i]
        depth, parent, node = lcp(s, other), None, root
        while type(node) is tuple and node[0] < depth:
            parent, node = node, node[1][byte(s, node[0])]
        if type(node) is tuple and node[0] == depth:
            node[1][byte(s, depth)] = i
            continue
        branch = (depth, {byte(s, depth): i, byte(other, depth): node})
        if parent is None:
            root = branch
        else:
            parent[1][byte(s, parent[0])] = branch
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        if type(node) is tuple:
            stack.extend(node[1][k] for k in sorted(node[1], reverse=True))
        else:
            order.extend(equal[node])
    return order


def deep_shallow(rows: np.ndarray, lengths: np.ndarray, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of zero-padded strings within their groups, and the common prefix with the one before.

    ``groups`` ascends; the prefix shared with another group's string is -1.
    """
    n = len(rows)
    symbols = rows.view(">u8").astype(_U)
    order = np.arange(n)
    part = groups.copy()
    depth = np.zeros(n, np.int64)
    deep: list[tuple[int, int]] = []
    at = np.arange(n)  # places in order that are still to be sorted
    while len(at):
        sizes = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1], [True]]))
        width = np.diff(sizes)
        at_depth = depth[sizes[:-1]]
        for s, w in zip(sizes[:-1][(width > 1) & (at_depth >= SHALLOW)], width[(width > 1) & (at_depth >= SHALLOW)], strict=True):
            deep.append((int(at[s]), int(w)))
        live = np.repeat((width > 1) & (at_depth < SHALLOW), width)
        if not live.any():
            break
        index = np.repeat(np.arange(len(width)), width)[live]
        middle = (sizes[:-1] + width // 2)
        at, depth = at[live], depth[live]
        own = symbols[order[at], depth]
        # Pivot: the symbol in the middle of each part.
        every = np.zeros(len(part), _U)
        every[live] = own
        pivot = every[middle][index]
        side = np.where(own < pivot, 0, np.where(own == pivot, 1, 2))
        key = index * 3 + side
        turn = np.argsort(key, kind="stable")
        order[at] = order[at][turn]
        part, depth = key[turn], depth[turn] + (side[turn] == 1)
    for start, width in deep:
        members = order[start:start + width]
        known = SHALLOW * 8 if lengths[members].min() >= SHALLOW * 8 else 0
        strings = [rows[m, known: lengths[m]].tobytes() for m in members]
        if width == 2:
            if strings[0] > strings[1]:
                order[start:start + 2] = members[::-1]
        else:
            order[start:start + width] = members[blind_trie_order(strings)]
    shared = np.full(n, -1, np.int64)
    if n > 1:
        differ = rows[order[1:]] != rows[order[:-1]]
        first = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])
        first = np.minimum(first, np.minimum(lengths[order[1:]], lengths[order[:-1]]))
        shared[1:] = np.where(groups[order[1:]] == groups[order[:-1]], first, -1)
    return order, shared


def later_windows(a: np.ndarray, docs: np.ndarray, tags: np.ndarray, places: np.ndarray, segments: list[bytes]) -> np.ndarray:
    """Matrix (run, window) of the windows that equal one of an earlier run; runs sorted by anchor."""
    anchors, _, counts, offsets = unpacked(places)
    n = len(a)
    right, left = np.zeros((n, 104), np.uint8), np.zeros((n, 104), np.uint8)
    right_len, left_len = np.zeros(n, np.int64), offsets.copy()
    for i, (segment, off) in enumerate(zip(segments, offsets.tolist(), strict=True)):
        r = segment[off:off + LENGTH]
        right[i, : len(r)] = np.frombuffer(r, np.uint8)
        right_len[i] = len(r)
        if off:
            left[i, :off] = np.frombuffer(segment[:off], np.uint8)[::-1]
    groups = np.cumsum(np.concatenate([[0], (a[1:] != a[:-1]).astype(np.int64)]))
    r_order, r_shared = deep_shallow(right, right_len, groups)
    l_order, l_shared = deep_shallow(left, left_len, groups)
    r_rank, l_rank, earlier = np.empty(n, np.int64), np.empty(n, np.int64), np.empty(n, np.int64)
    r_rank[r_order] = np.arange(n)
    l_rank[l_order] = np.arange(n)
    earlier[np.lexsort((anchors, tags, docs))] = np.arange(n)
    later = np.zeros((n, WIDTH), bool)
    for d in range(WIDTH):
        own = np.flatnonzero((offsets - counts < d) & (d <= offsets))
        if len(own) < 2:
            continue
        key = (np.cumsum(r_shared < LENGTH - d)[r_rank[own]] << 32) | np.cumsum(l_shared < d)[l_rank[own]]
        order = np.lexsort((earlier[own], key))
        again = order[1:][key[order][1:] == key[order][:-1]]
        later[own[again], offsets[own[again]] - d] = True
    return later


GONE = pa.schema([("doc", pa.int64()), ("tag", pa.int64()), ("place", pa.int64())])
GONE_SQL = "doc long, tag long, place long"


def _sorted_runs(batches):
    """Later windows of whole anchor groups; rows come sorted by anchor."""
    held: list[pa.RecordBatch] = []
    size = 0

    def settle(rows: pa.Table) -> pa.RecordBatch:
        a, docs, tags, places = (rows[c].to_numpy() for c in ("a", "doc", "tag", "place"))
        order = np.lexsort((places, tags, docs, a))
        keep = np.ones(len(order), bool)
        keep[1:] = np.any([x[order][1:] != x[order][:-1] for x in (a, docs, tags, places)], axis=0)
        order = order[keep]
        a, docs, tags, places = a[order], docs[order], tags[order], places[order]
        segments = rows["segment"].to_pylist()
        later = later_windows(a, docs, tags, places, [segments[i] for i in order])
        _, starts, _, _ = unpacked(places)
        edges = np.diff(np.pad(later, ((0, 0), (1, 1))).astype(np.int8), axis=1)
        row, begin = np.nonzero(edges == 1)
        _, end = np.nonzero(edges == -1)
        return batch_of({"doc": docs[row], "tag": tags[row], "place": packed_place(starts[row] + begin, end - begin, 0)}, GONE)

    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size < 20_000:
            continue
        rows = pa.Table.from_batches(held)
        a = rows["a"].to_numpy()
        cut = int(np.searchsorted(a, a[-1], side="left"))
        if cut:
            yield settle(rows.slice(0, cut))
            rows = rows.slice(cut)
        held, size = rows.to_batches(), rows.num_rows
    if size:
        yield settle(pa.Table.from_batches(held))


def compressed(docs: DataFrame) -> DataFrame:
    """Texts under their id and tag, compressed for the shuffle."""
    schema = pa.schema([("doc", pa.int64()), ("tag", pa.int64()), ("body", pa.binary())])

    def run(batches):
        pack = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            for part in pieces_of(batch, "text"):
                texts = [(t or "").encode() for t in part["text"].to_pylist()]
                yield batch_of({"doc": part["doc"], "tag": list(map(text_tag, texts)), "body": list(map(pack.compress, texts))}, schema)

    return map_arrow(docs, run, "doc long, tag long, body binary")


def _segments(batches):
    """Bytes of the runs wanted of each text; for runs of crowded anchors a row per window."""
    schema = pa.schema([("a", pa.int64()), ("doc", pa.int64()), ("tag", pa.int64()), ("place", pa.int64()), ("segment", pa.binary()),
                        ("w1", pa.int64()), ("w2", pa.int64())])
    unpack = zstandard.ZstdDecompressor()
    for batch in batches:
        rows: list[tuple] = []
        size = 0
        for doc, tag, body, runs in zip(*(batch[c].to_pylist() for c in ("doc", "tag", "body", "runs")), strict=True):
            text = unpack.decompress(body)
            for r in runs:
                _, start, count, _ = unpacked(r["place"])
                if r["crowded"]:
                    for s in range(start, start + count):
                        digest = hashlib.blake2b(text[s:s + LENGTH], digest_size=16).digest()
                        rows.append((r["a"], doc, tag, packed_place(s, 1, 0), None,
                                     int.from_bytes(digest[:8], "little", signed=True),
                                     int.from_bytes(digest[8:], "little", signed=True)))
                else:
                    rows.append((r["a"], doc, tag, r["place"], text[start:start + count - 1 + LENGTH], None, None))
            size += len(text)
            if size > CHUNK_BYTES or len(rows) > 50_000:
                yield batch_of(dict(zip(schema.names, zip(*rows, strict=True), strict=True)) if rows else
                               dict.fromkeys(schema.names, ()), schema)
                rows, size = [], 0
        if rows:
            yield batch_of(dict(zip(schema.names, zip(*rows, strict=True), strict=True)), schema)


OUT = pa.schema([("doc", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
                 ("kept_sha256", pa.string()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))),
                 ("kept", pa.binary())])
OUT_SQL = ("doc long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
           "spans array<struct<start:bigint,stop:bigint>>, kept binary")


def _cutter(with_text: bool):
    def run(batches):
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            rows, size = [], 0
            for doc, body, gone in zip(*(batch[c].to_pylist() for c in ("doc", "body", "gone")), strict=True):
                text = unpack.decompress(body)
                spans = merged(gone or [])
                parts, at = [], 0
                for start, stop in spans:
                    parts.append(text[at:start])
                    at = stop
                kept = b"".join([*parts, text[at:]])
                rows.append((doc, len(text), len(text) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(),
                             [{"start": s, "stop": e} for s, e in spans], kept if with_text else None))
                size += len(text)
                if size > CHUNK_BYTES:
                    yield batch_of(dict(zip(OUT.names, zip(*rows, strict=True), strict=True)), OUT)
                    rows, size = [], 0
            if rows:
                yield batch_of(dict(zip(OUT.names, zip(*rows, strict=True), strict=True)), OUT)

    return run


def merged(places: list[int]) -> list[tuple[int, int]]:
    """Byte ranges covered by the windows at ``places``, as maximal runs."""
    if not places:
        return []
    _, starts, counts, _ = unpacked(np.sort(np.array(places, np.int64)))
    stops = np.maximum.accumulate(starts + counts - 1 + LENGTH)
    new = np.concatenate([[True], starts[1:] > stops[:-1]])
    last = np.concatenate([np.flatnonzero(new)[1:] - 1, [len(starts) - 1]])
    return list(zip(starts[new].tolist(), stops[last].tolist(), strict=True))


def repeated_places(docs: DataFrame, group_limit: int) -> DataFrame:
    """(doc, tag, place) of every window that starts earlier too; ``docs``: doc, text."""
    rows = map_arrow(docs, _runs, "a long, settled boolean, c long, doc long, tag long, place long, copied boolean")
    anchor = Window.partitionBy("a", "settled")
    # A pair needs two rows of its anchor, or one that was merged in its task.
    counted = rows.withColumns({
        "rows": F.count(F.lit(1)).over(anchor), "low": F.min("c").over(anchor), "high": F.max("c").over(anchor)})
    ranked = counted.where("settled or copied or rows > 1").withColumn(
        "rank", F.rank().over(Window.partitionBy("a", "settled", "c").orderBy("doc", "tag", "place")))
    marked = table(ranked.select(
        "a", "doc", "tag", "place", (~F.col("settled") & (F.col("rank") == 1)).alias("first"),
        (F.col("low") != F.col("high")).alias("varied"), (F.col("rows") > group_limit).alias("crowded")), "runs")
    later = marked.where(~F.col("first")).select("doc", "tag", "place")
    wanted = marked.where("first and varied")
    per_doc = wanted.groupBy("doc", "tag").agg(F.collect_list(F.struct("a", "place", "crowded")).alias("runs"))
    # Not the texts but the runs are the small side.
    segments = map_arrow(
        compressed(docs).join(per_doc.hint("shuffle_hash"), ["doc", "tag"]).select("doc", "tag", "body", "runs"), _segments,
        "a long, doc long, tag long, place long, segment binary, w1 long, w2 long")
    grouped = segments.where(F.col("segment").isNotNull()).repartition("a").sortWithinPartitions("a")
    gone = later.unionByName(map_arrow(grouped.select("a", "doc", "tag", "place", "segment"), _sorted_runs, GONE_SQL))
    if marked.where("first and varied and crowded").limit(1).count():
        window = Window.partitionBy("w1", "w2").orderBy("doc", "tag", "place")
        crowded = segments.where(F.col("w1").isNotNull()).withColumn("rank", F.rank().over(window))
        gone = gone.unionByName(crowded.where("rank > 1").select("doc", "tag", "place"))
    return gone


def remove_repeats(docs: DataFrame, *, with_text: bool = True, group_limit: int = 50_000) -> DataFrame:
    """Per document: bytes, removed bytes, their spans, and the remaining bytes (``kept``) with their digest."""
    source = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"), F.col("text").cast("string").alias("text"))
    gone = repeated_places(source, group_limit)
    per_doc = gone.groupBy("doc", "tag").agg(F.collect_list("place").alias("gone"))
    texts = compressed(source)
    joined = texts.join(per_doc.hint("shuffle_hash"), ["doc", "tag"], "left").select("doc", "body", "gone")
    out = map_arrow(joined, _cutter(with_text), OUT_SQL)
    return out.select(F.when(F.col("doc") != NO_ID, F.col("doc")).alias("doc_id"), *OUT.names[1:])

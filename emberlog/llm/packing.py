"""Best-fit packing with certified bin counts.

Documents become token ids; longer ones than a sequence are cut into full pieces from the
end, so that only their first piece has to share a sequence.  Pieces are dealt to partitions
of about ``per_partition`` pieces by a hash, and each partition packs its own by best-fit
decreasing.  Dual-feasible functions give a lower bound on the bins the partition's pieces
need: where it equals the bins used, the partition is certified and final.  Partitions with
a gap exchange pieces - all of theirs outside full bins are dealt anew among them - and pack
again; a round that needs more bins than its pieces had before is discarded.

Tasks hold one partition of piece lengths; texts leave the first pass as counts and
checksums.  A hot source or id changes nothing, as dealing is by hash of the piece.

Defined results: null and empty texts are the separator alone; repeated rows are packed
each on its own; an empty table gives no rows.  Only doc_id and text are read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlog.llm.common import batch_of, map_arrow, pieces_of, table
from emberlog.llm.tokens import ByteIds

LENGTH = 1024
SEPARATOR = 2


def encoder() -> ByteIds:
    """Byte-level BPE of ``byte_bpe_50k.json``; special strings in a text are ordinary text."""
    return ByteIds()


PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


def tokenised(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """The pieces of every document: place, length and checksum of the ids."""
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
                        ("length", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batches):
        code = None
        for batch in batches:
            code = code or encoder()
            for part in pieces_of(batch, "text"):
                rows = []
                for doc, text in zip(part["doc_id"].to_pylist(), part["text"].to_pylist(), strict=True):
                    ids = np.append(code.ids(text or ""), SEPARATOR).astype("<u4")
                    first = len(ids) % length or length
                    cuts = [0, *range(first, len(ids) + 1, length)]
                    rows += [(doc, i, a, b - a, zlib.crc32(ids[a:b].tobytes()))
                             for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]
                yield batch_of(dict(zip(schema.names, zip(*rows, strict=True), strict=True)) if rows else
                               dict.fromkeys(schema.names, ()), schema)

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_arrow(source, run, PIECE)


def lower_bound(sizes: np.ndarray, length: int = LENGTH) -> int:
    """Fewest bins any packing of ``sizes`` needs, by dual-feasible functions.

    A dual-feasible function maps any set of sizes that fits one bin to a sum of one at
    most.  Two families: sizes above ``length - t`` count whole and those below ``t``
    nothing; and sizes rounded down to multiples of ``length / (k + 1)``.
    """
    counts = np.bincount(sizes, minlength=length + 1)[: length + 1].astype(np.int64)
    x = np.arange(length + 1, dtype=np.int64)
    total = int((counts * x).sum())
    best = -(-total // length)
    number, weight = np.cumsum(counts), np.cumsum(counts * x)
    t = np.arange(0, length // 2 + 1)
    large = number[-1] - number[length - t]
    middle = weight[length - t] - np.where(t > 0, weight[np.maximum(t - 1, 0)], 0)
    best = max(best, int((large + -(-middle // length)).max()))
    for k in range(1, 60):
        parts = (k + 1) * x
        exact = parts % length == 0
        # value / (k * length): k * x where exact, floor((k + 1) x / length) * length otherwise
        value = int((counts * np.where(exact, k * x, (parts // length) * length)).sum())
        best = max(best, -(-value // (k * length)))
    return best


def best_fit(sizes: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, int]:
    """Bin and offset of each size by best-fit decreasing, and the number of bins.

    Open bins are kept by free room; a bit set of the rooms in use finds the tightest one.
    """
    order = np.argsort(-sizes, kind="stable")
    bins, offsets = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    open_by_room: list[list[int]] = [[] for _ in range(length + 1)]
    in_use, made = 0, 0
    for i, size in zip(order.tolist(), sizes[order].tolist(), strict=True):
        fitting = in_use >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            own = open_by_room[room]
            b = own.pop()
            if not own:
                in_use &= ~(1 << room)
        else:
            room, b = length, made
            made += 1
        bins[i], offsets[i] = b, length - room
        left = room - size
        if left:
            open_by_room[left].append(b)
            in_use |= 1 << left
    return bins, offsets, made


PACKED = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                    ("ids_crc32", pa.int64()), ("part", pa.int64()), ("bin", pa.int64()), ("offset", pa.int64()),
                    ("gap", pa.int64())])
PACKED_SQL = f"{PIECE}, part long, bin long, offset long, gap long"


def _packer(length: int):
    def run(key, group):
        # An order of its own, so that a retried task packs alike.
        group = group.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"),
                               ("ids_crc32", "ascending")])
        sizes = group["length"].to_numpy()
        bins, offsets, made = best_fit(sizes, length)
        gap = made - lower_bound(sizes, length)
        out = {n: group[n] for n in ("doc_id", "piece", "start", "length", "ids_crc32", "part")}
        return pa.table({**out, "bin": bins, "offset": offsets, "gap": np.full(len(sizes), gap)}, schema=PACKED)

    return run


def packed(pieces: DataFrame, parts: int, turn: int, length: int) -> DataFrame:
    """One round: pieces dealt to ``parts`` partitions by the round's hash, each packed."""
    dealt = pieces.withColumn("part", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", F.lit(turn)), F.lit(parts)))
    return dealt.groupBy("part").applyInArrow(_packer(length), PACKED_SQL)


def pack(docs: DataFrame, *, length: int = LENGTH, per_partition: int = 20_000, rounds: int = 3) -> DataFrame:
    """Sequence and offset of every piece, with the bin count certified where it can be."""
    pieces = table(tokenised(docs, length), "pieces")
    whole = pieces.where(F.col("length") == length).select(
        *[f.split()[0] for f in PIECE.split(", ")], F.lit(-1).alias("turn"), F.lit(0).cast("long").alias("part"),
        F.monotonically_increasing_id().alias("bin"), F.lit(0).cast("long").alias("offset"),
        F.lit(0).cast("long").alias("gap"))
    rest, done = pieces.where(F.col("length") < length), [whole]
    before = None
    for turn in range(rounds):
        n = rest.count()
        if not n:
            break
        result = table(packed(rest, max(1, -(-n // per_partition)), turn, length), "packed").withColumn("turn", F.lit(turn))
        per_bin = result.groupBy("part", "bin").agg(F.sum("length").alias("_used"), F.max("gap").alias("_gap"))
        if before is not None and per_bin.count() > before[1]:
            done.append(before[0])
            break
        # Certified partitions are final.  So are the full bins of the others: nothing can
        # be packed tighter than they are.
        per_bin = per_bin.withColumn("_final", (F.col("_gap") == 0) | (F.col("_used") == length))
        settled = result.join(per_bin.select("part", "bin", "_final"), ["part", "bin"])
        done.append(settled.where("_final").drop("_final"))
        again = settled.where(~F.col("_final")).drop("_final")
        if turn == rounds - 1:
            done.append(again)
        before = again, per_bin.where(~F.col("_final")).count()
        rest = again.select(*pieces.columns)
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    # Rounds, partitions and bins side by side in one number.
    sequence = F.when(F.col("turn") < 0, F.col("bin") * 4).otherwise(
        (F.col("part") * (1 << 30) + F.col("bin")) * 4 + 1 + F.col("turn"))
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", sequence.alias("sequence_id"), "offset",
                      "gap", "turn")

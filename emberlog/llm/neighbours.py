"""Nearest neighbours by a block matrix join with int8 product tiles.

Queries and candidates are dealt to blocks by a hash of their id and vector; every pair of
blocks is a tile and one task's work.  In a tile, unit vectors are rounded to eight bits and multiplied;
the rounding errors of both sides bound how far a product can be from the cosine.  Only pairs
whose upper bound reaches the k-th lower bound of their query, or the k-th cosine found so
far, are computed from the original vectors in double precision, and heaps keep the best k.
The lists of a query's tiles are merged by a heap again.  The result is exact.

Equal rows are combined first, within their tasks and then across them, so a row repeated any
number of times is one; rows that repeat an id with different vectors spread over the blocks.
Blocks therefore bound a task's memory whatever the table's size or its commonest id.  A query
block is sent to each candidate block once, and the other way round, so rows travel as often
as there are query blocks: all pairs are compared, in work and in shuffle.

Defined results: vectors that are null, empty, zero, or hold a null, NaN or infinity take no
part; vectors only meet those of their own length; of rows that repeat an id the nearest
counts, for a repeated query id over all its vectors; finite components of any size give a
finite cosine; a query alone has no rows.  Only vec_id and embedding are read.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlog.llm.common import batch_of, map_arrow, table

QUERY_BLOCK = 2048
BLOCK = 8192
STEP_QUERIES, STEP_ROWS = 256, 4096


def valid_vectors(embeddings: DataFrame) -> DataFrame:
    """(vec_id, dim, body): the usable vectors as double-precision bytes."""
    schema = pa.schema([("vec_id", pa.int64()), ("dim", pa.int32()), ("body", pa.binary())])

    def run(batches):
        for batch in batches:
            ids, dims, bodies = [], [], []
            lists = batch["embedding"]
            flat = lists.flatten()
            holes = np.cumsum(np.concatenate([[0], flat.is_null().to_numpy(zero_copy_only=False)]))
            values = flat.to_numpy(zero_copy_only=False).astype(np.float64)
            sizes = np.diff(lists.offsets.to_numpy()) if len(lists) else np.zeros(0, np.int64)
            # Null lists hold no values after flatten().
            sizes = np.where(lists.is_null().to_numpy(zero_copy_only=False), 0, sizes)
            ends = np.cumsum(sizes)
            for vec, a, b in zip(batch["vec_id"].to_pylist(), (ends - sizes).tolist(), ends.tolist(), strict=True):
                own = values[a:b]
                if vec is None or holes[b] > holes[a] or not np.isfinite(own).all() or not own.any():
                    continue
                ids.append(vec)
                dims.append(b - a)
                bodies.append(own.tobytes())
            yield batch_of({"vec_id": ids, "dim": dims, "body": bodies}, schema)

    source = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    return map_arrow(source, run, "vec_id long, dim int, body binary")


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Each row times a power of two, its largest component between 1/2 and 1.

    Keeps every digit, and squares of very large or small components stay finite.
    """
    _, power = np.frexp(np.abs(vectors).max(axis=1))
    return np.ldexp(vectors, -power[:, None])


class Rounded:
    """Unit vectors of :func:`scaled` ones in eight bits, with what the rounding can cost."""

    def __init__(self, vectors: np.ndarray):
        unit = vectors / np.sqrt((vectors * vectors).sum(axis=1))[:, None]
        self.scale = np.abs(unit).max(axis=1) / 127
        self.cells = np.rint(unit / self.scale[:, None]).astype(np.int8)
        rest = unit - self.cells * self.scale[:, None]
        self.error = np.sqrt((rest * rest).sum(axis=1)) + 1e-12

    def product(self, other: Rounded, rows: slice, columns: slice) -> tuple[np.ndarray, np.ndarray]:
        """Products of a tile and a bound of their distance from the cosine."""
        # Sums of int8 products are whole numbers below 2**24 up to 1040 dimensions, exact in float32.
        kind = np.float32 if self.cells.shape[1] <= 1040 else np.float64
        whole = self.cells[rows].astype(kind) @ other.cells[columns].astype(kind).T
        near = whole * self.scale[rows, None] * other.scale[None, columns]
        mine, theirs = self.error[rows, None], other.error[None, columns]
        return near, mine + (1 + mine) * theirs + 1e-9


def cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Cosine of each row of ``x`` with the same row of ``y``, in double precision."""
    norms = np.sqrt((x * x).sum(axis=1)) * np.sqrt((y * y).sum(axis=1))
    return (x * y).sum(axis=1) / norms


def offer(heap: list[tuple[float, int]], entry: tuple[float, int], k: int) -> None:
    """Puts (score, -id) into a heap of the best k ids; an id counts once, with its best score."""
    same = next((i for i, held in enumerate(heap) if held[1] == entry[1]), None)
    if same is not None:
        if entry > heap[same]:
            heap[same] = entry
            heapq.heapify(heap)
    elif len(heap) < k:
        heapq.heappush(heap, entry)
    elif entry > heap[0]:
        heapq.heapreplace(heap, entry)


def tile_neighbours(query_ids, queries, ids, vectors, k: int) -> list[tuple[int, int, float]]:
    """The k nearest ids of a tile for each query row: (query, vector, cosine)."""
    order = np.argsort(ids, kind="stable")
    queries, ids, vectors = scaled(queries), ids[order], scaled(vectors[order])
    q, c = Rounded(queries), Rounded(vectors)
    heaps: list[list[tuple[float, int]]] = [[] for _ in query_ids]
    for i in range(0, len(query_ids), STEP_QUERIES):
        rows = slice(i, min(i + STEP_QUERIES, len(query_ids)))
        for j in range(0, len(ids), STEP_ROWS):
            columns = slice(j, min(j + STEP_ROWS, len(ids)))
            near, bound = q.product(c, rows, columns)
            own = query_ids[rows, None] == ids[None, columns]
            low = np.where(own, -np.inf, near - bound)
            # The k-th best lower bound of different ids: rows of one id stand together.
            firsts = np.flatnonzero(np.concatenate([[True], np.diff(ids[columns]) != 0]))
            if len(firsts) < low.shape[1]:
                low = np.maximum.reduceat(low, firsts, axis=1)
            place = max(low.shape[1] - k, 0)
            least = np.partition(low, place, axis=1)[:, place] if low.shape[1] >= k else np.full(low.shape[0], -np.inf)
            known = np.array([h[0][0] if len(h) == k else -np.inf for h in heaps[rows]])
            r, s = np.nonzero((near + bound >= np.maximum(least, known)[:, None]) & ~own)
            exact = cosines(queries[rows][r], vectors[columns][s])
            for a, b, score in zip((r + i).tolist(), (s + j).tolist(), exact.tolist(), strict=True):
                offer(heaps[a], (score, -int(ids[b])), k)
    return [(int(query), -vec, score) for query, heap in zip(query_ids.tolist(), heaps, strict=True) for score, vec in heap]


FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def _tile(k: int):
    def run(key, rows):
        asked = rows["query"].to_numpy(zero_copy_only=False)
        ids = rows["vec_id"].to_numpy()
        dim = rows["dim"][0].as_py()
        vectors = np.frombuffer(b"".join(rows["body"].to_pylist()), np.float64).reshape(-1, dim)
        found = tile_neighbours(ids[asked], vectors[asked], ids[~asked], vectors[~asked], k) if asked.any() and not asked.all() else []
        return pa.table({n: pa.array([f[i] for f in found], FOUND.field(n).type) for i, n in enumerate(FOUND.names)}, schema=FOUND)

    return run


def _merge(k: int):
    schema = pa.schema([("query_id", pa.int64()), ("rank", pa.int32()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def best(query: int, heap: dict[int, float]) -> list[tuple]:
        top = heapq.nsmallest(k, heap.items(), key=lambda x: (-x[1], x[0]))
        return [(query, i + 1, vec, score) for i, (vec, score) in enumerate(top)]

    def run(batches):
        query, held = None, {}
        for batch in batches:
            rows = []
            for q, v, s in zip(*(batch[c].to_pylist() for c in FOUND.names), strict=True):
                if q != query:
                    if held:
                        rows += best(query, held)
                    query, held = q, {}
                held[v] = max(s, held.get(v, -2.0))
                if len(held) > 64 * k:
                    held = {vec: score for _, _, vec, score in best(query, held)}
            if rows:
                yield batch_of(dict(zip(schema.names, zip(*rows, strict=True), strict=True)), schema)
        if held:
            yield batch_of(dict(zip(schema.names, zip(*best(query, held), strict=True), strict=True)), schema)

    return run


def nearest(embeddings: DataFrame, *, k: int = 5, every: int = 50, query_block: int = QUERY_BLOCK, block: int = BLOCK) -> DataFrame:
    """The ``k`` nearest of every row whose id is divisible by ``every``: (query_id, rank, vec_id, score)."""
    vectors = table(valid_vectors(embeddings).distinct(), "vectors")
    asked = vectors.where(F.col("vec_id") % every == 0)
    counts = vectors.agg(F.count(F.lit(1)), F.count(F.when(F.col("vec_id") % every == 0, 1))).first()
    many, few = max(1, -(-counts[0] // block)), max(1, -(-counts[1] // query_block))

    def dealt(own: int, salt: int):
        return F.pmod(F.xxhash64("vec_id", "body", F.lit(salt)), F.lit(own)).cast("int")

    to_all = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    queries = asked.select("*", F.lit(True).alias("query"), dealt(few, 1).alias("qb"), to_all(many).alias("cb"))
    rows = vectors.select("*", F.lit(False).alias("query"), dealt(many, 2).alias("cb"), to_all(few).alias("qb"))
    tiles = queries.unionByName(rows).groupBy("dim", "qb", "cb").applyInArrow(_tile(k), "query_id long, vec_id long, score double")
    lists = tiles.repartition("query_id").sortWithinPartitions("query_id")
    return map_arrow(lists, _merge(k), "query_id long, rank int, vec_id long, score double")

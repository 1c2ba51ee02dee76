"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlog.session import materialise

ROOT = str(Path(__file__).resolve().parents[2])
CHUNK_BYTES = 4 << 20


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver found it."""
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if ROOT not in known.split(":"):
        spark.sparkContext.environment["PYTHONPATH"] = f"{ROOT}:{known}" if known else ROOT


def map_arrow(df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterable[pa.RecordBatch]],
              schema: str) -> DataFrame:
    """``mapInArrow`` with the package importable on every worker."""
    ship_package(df.sparkSession)
    return df.mapInArrow(function, schema)


def table(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder once, and read back."""
    return materialise(df, name)


def packed(docs: DataFrame, **columns: Column) -> DataFrame:
    """``columns`` beside the whole row as ``doc``, so that no name of the row can clash."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), *[
        value.alias(name) for name, value in columns.items()])


def unpacked(rows: DataFrame, docs: DataFrame, **replaced: Column) -> DataFrame:
    """The rows' own columns again, in order, some of them ``replaced``."""
    return rows.select(*[replaced.get(c, F.col("doc").getField(c)).alias(c) for c in docs.columns])


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that no model may learn from: one in five, by the id's checksum."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0


def pieces_of(batch: pa.RecordBatch, column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose ``column`` holds about ``limit`` bytes; one row at least.

    Keeps working memory bounded whatever the batch size or text length is.
    """
    sizes = pc.fill_null(pc.binary_length(batch[column]), 0)
    ends = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64))
    first, base = 0, 0
    while first < batch.num_rows:
        last = max(first + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield batch.slice(first, last - first)
        base, first = int(ends[last - 1]), last


def flat_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string or binary column in a row, and where each value ends.

    Null counts as empty.
    """
    values = [b"" if v is None else v for v in column.cast(pa.large_binary()).to_pylist()]
    ends = np.cumsum(np.fromiter(map(len, values), np.int64, len(values)))
    return np.frombuffer(b"".join(values), np.uint8), ends


def batch_of(columns: dict[str, object], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)



HEAVY_KEYS = 10_000


def weighted_join(rows: DataFrame, side: DataFrame, keys: list[str], load: str, total: int) -> DataFrame:
    """Inner join of ``rows`` with the one row per key that ``side`` holds, safe against hot keys.

    ``side[load]`` says how many of the ``total`` rows have the key.  Fewer than
    ``HEAVY_KEYS`` keys can each have more than ``total / HEAVY_KEYS`` rows, so those are
    broadcast whatever the size of the input, and no key left for the shuffled join has
    more rows than that.
    """
    heavy = F.col(load) * HEAVY_KEYS > total
    hot = F.broadcast(side.where(heavy).drop(load))
    light = side.where(~heavy).drop(load)
    at_once = rows.join(hot, keys)
    shuffled = rows.join(hot.select(*keys), keys, "left_anti").join(light, keys)
    return at_once.unionByName(shuffled)

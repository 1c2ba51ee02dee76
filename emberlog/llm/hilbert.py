"""Sharding along a Hilbert curve, with DataFrame functions only.

Metadata dimensions are quantised to a few bits each; the position of a row's cell on the
Hilbert curve orders the rows, so that a run of the curve spans a small box in every
dimension and readers can prune files by the minima and maxima of each.  The curve is cut
into ``shards`` runs whose row counts differ by one at most (law ``rows``).

The global rank needs no single task: rows are range-partitioned by (curve, id, checksum),
written once with their place inside the partition, and the counts of the partitions before
it are added.  A cell with a third of all rows is split by the id like any other range.

Defined results: a null text has size 1 and the checksum of the empty text; null dimension
values take the lowest cell; repeated rows get places of their own; an empty table gives no
rows.  Only the named columns are read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emberlog.llm.common import table

BITS = 5


def text_code(column: Column, width: int = 6) -> Column:
    """The first ``width`` bytes of a text as a number that orders like the text."""
    head = F.rpad(F.hex(F.substring(F.encode(F.coalesce(column, F.lit("")), "UTF-8"), 1, width)), 2 * width, "0")
    return F.conv(head, 16, 10).cast("double")


def size_code(column: Column) -> Column:
    """Binary magnitude of a size in half steps: its number of bits twice, and its second bit."""
    bits = F.length(F.bin(F.greatest(column.cast("long"), F.lit(2).cast("long"))))
    second = F.substring(F.bin(F.greatest(column.cast("long"), F.lit(2).cast("long"))), 2, 1).cast("int")
    return (2 * bits + second).cast("double")


def quantised(df: DataFrame, codes: dict[str, Column], bits: int = BITS) -> DataFrame:
    """Adds ``<name>_cell``: where each code lies between its least and greatest value.

    The bounds are one row, so joining them costs a broadcast of that row.
    """
    coded = df.withColumns({f"{n}_code": c for n, c in codes.items()})
    bounds = coded.agg(*[f(f"{n}_code").alias(f"{n}_{f.__name__}") for n in codes for f in (F.min, F.max)])
    top = (1 << bits) - 1

    def cell(n: str) -> Column:
        span = F.col(f"{n}_max") - F.col(f"{n}_min")
        place = F.floor((F.col(f"{n}_code") - F.col(f"{n}_min")) * (1 << bits) / span)
        return F.least(F.when(span > 0, F.coalesce(place, F.lit(0))).otherwise(F.lit(0)), F.lit(top)).cast("long")

    return coded.join(F.broadcast(bounds)).withColumns({f"{n}_cell": cell(n) for n in codes}).drop(
        *[f"{n}_{x}" for n in codes for x in ("code", "min", "max")])


def bound(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def curve_index(cells: list[Column], bits: int = BITS) -> Column:
    """Place of a cell on the Hilbert curve through all cells.

    Coordinates are un-rotated bit by bit from the top, then Gray-coded and interleaved.
    """
    n = len(cells)
    start = F.array(*[c.cast("long") for c in cells])
    steps = F.array(*[F.struct(F.lit(1 << b).cast("long").alias("q"), F.lit(i).alias("i"))
                      for b in range(bits - 1, 0, -1) for i in range(n)])

    def turn(x: Column, step: Column) -> Column:
        q, low = step["q"], step["q"] - 1
        own, first = F.get(x, step["i"]), F.get(x, F.lit(0))
        swap = first.bitwiseXOR(own).bitwiseAND(low)
        is_set = own.bitwiseAND(q) != 0
        return F.transform(x, lambda v, k: F.when(
            k == 0, v.bitwiseXOR(F.when(is_set, low).otherwise(swap))
        ).when((k == step["i"]) & ~is_set, v.bitwiseXOR(swap)).otherwise(v))

    turned = F.aggregate(steps, start, turn)
    # Gray code: each coordinate takes the exclusive or of all before it.
    gray = F.aggregate(turned, F.array().cast("array<long>"), lambda acc, v: F.concat(
        acc, F.array(v.bitwiseXOR(F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit(0).cast("long"))))))
    bits_down = F.array(*[F.lit(1 << b).cast("long") for b in range(bits - 1, 0, -1)])

    def flipped(g: Column) -> Column:
        tail = F.element_at(g, -1)
        flip = F.aggregate(bits_down, F.lit(0).cast("long"), lambda t, q: F.when(
            tail.bitwiseAND(q) != 0, t.bitwiseXOR(q - 1)).otherwise(t))
        return bound(flip, lambda f: F.transform(g, lambda v: v.bitwiseXOR(f)))

    def interleaved(coords: Column) -> Column:
        places = [(b, i) for b in range(bits - 1, -1, -1) for i in range(n)]
        picked = [F.shiftleft(F.shiftright(F.get(coords, F.lit(i)), b).bitwiseAND(F.lit(1).cast("long")), len(places) - 1 - k)
                  for k, (b, i) in enumerate(places)]
        return reduce(Column.bitwiseOR, picked)

    return bound(bound(gray, flipped), interleaved)


def ranked(df: DataFrame, order: list[str]) -> DataFrame:
    """Adds ``place``: the row's rank from 0 in the total order of ``order``; and ``total``."""
    local = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(
        "_at", F.monotonically_increasing_id())
    # Written once: ranks must not depend on a second sampling of the ranges.
    local = table(local, "curve").withColumns({
        "_part": F.shiftright("_at", 33), "_at": F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))})
    # One row per partition, not per document.
    counts = local.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        F.sum("_n").over(Window.partitionBy()).alias("total"))
    return local.join(F.broadcast(offsets), "_part").withColumn("place", F.col("_at") + F.col("_before")).drop(
        "_part", "_at", "_before")


def shard_by_curve(docs: DataFrame, *, shards: int = 8, dimensions: dict[str, Column] | None = None,
                   bits: int = BITS, carry: str | None = None) -> DataFrame:
    """Shard and slot of every document, in curve order.

    ``carry`` names a column to pass on.  ``dimensions`` maps names to numeric codes; default: size magnitude, source, language.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    codes = dimensions or {
        "size": size_code(F.col("size")), "source": text_code(F.col("source")), "lang": text_code(F.col("lang"))}
    names = list(codes)
    more = [carry] if carry else []
    narrow = docs.withColumn("size", (F.octet_length(text) + 1).cast("long")).select(
        F.col("doc_id").cast("long").alias("doc_id"), "size", F.crc32(text.cast("binary")).alias("text_crc32"),
        *[c.alias(f"{n}_code") for n, c in codes.items()], *more)
    # Texts are read once; bounds, sampling and sorting work on this narrow table.
    celled = quantised(table(narrow, "sizes"), {n: F.col(f"{n}_code") for n in names}, bits)
    placed = celled.withColumn("curve", curve_index([F.col(f"{n}_cell") for n in names], bits)).select(
        "doc_id", "size", "text_crc32", "curve", *[f"{n}_cell" for n in names], *more)
    rank = ranked(placed, ["curve", "doc_id", "text_crc32"])
    # The first (total mod shards) shards hold one row more.
    small, extra = F.floor(F.col("total") / shards), F.col("total") % shards
    edge = extra * (small + 1)
    shard = F.when(F.col("place") < edge, F.floor(F.col("place") / (small + 1))).otherwise(
        extra + F.floor((F.col("place") - edge) / F.greatest(small, F.lit(1))))
    start = F.when(F.col("shard") < extra, F.col("shard") * (small + 1)).otherwise(
        edge + (F.col("shard") - extra) * small)
    return rank.withColumn("shard", shard.cast("int")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
        (F.col("place") - start).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
        "curve", *[f"{n}_cell" for n in names], *more)


def cut_files(docs: DataFrame, path: str, **options) -> None:
    """Writes the documents in curve order, one folder per shard.

    A column of the input named ``shard`` gives way to the shard.  Rows that agree in all that
    orders them (id, checksum and cell) get their places in any order, one each.
    """
    spare = unused(docs.columns)
    # Rows take a number of their own, written with them, so equal ids or checksums mix nothing up.
    own = table(docs.withColumn(spare, F.monotonically_increasing_id()), "numbered")
    placed = shard_by_curve(own, carry=spare, **options).select(spare, F.col("shard").alias(f"{spare}s"), "slot")
    joined = own.join(placed.withColumnRenamed("slot", f"{spare}t"), spare)
    columns = [F.col(f"`{c}`") for c in docs.columns if c != "shard"]
    joined.repartitionByRange(f"{spare}s", f"{spare}t").sortWithinPartitions(f"{spare}s", f"{spare}t").select(
        *columns, F.col(f"{spare}s").alias("shard")).write.partitionBy("shard").parquet(path)


def unused(names: list[str]) -> str:
    """A column name that starts none of ``names``, in any case."""
    name = "_n"
    while any(n.lower().startswith(name) for n in names):
        name += "_"
    return name

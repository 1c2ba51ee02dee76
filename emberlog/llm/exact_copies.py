"""Exact duplicates by skew-safe combining, with DataFrame functions only.

Two texts are equal when they are identical after white space (blank and 0x09-0x0D) is
deleted.  Equal texts are combined in three steps, each of which compares the whole
normalised text and not only its digest:

1. every task combines its own rows (the map side of the first aggregation);
2. the task's groups travel under (digest, salt, text), the salt being the task's number
   modulo ``salts``, so one common text is merged in many tasks;
3. the at most ``salts`` winners of a text meet under its digest and become one row.

A row's order - most code points, then least id, then a checksum of the original text - is
one decimal number, so all three are hash aggregations of fixed-width values.  Texts travel
twice, once before and once after salting; what is joined back to the rows is one narrow row
per group.  Digests that turn out to belong to one text only identify it, and rows are joined
by digest; for digests of several texts the texts themselves are joined.  Groups with more
than a ten-thousandth of all rows (so fewer than ten thousand) are broadcast in that join.

Defined results: null text counts as empty; all empty texts are one group; a null id comes
after all ids; of rows that tie in every respect one stays, the one read first; an empty
table gives no rows.  ``groups`` reads doc_id and text only; ``deduplicate`` passes all
columns on, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emberlog.llm.common import table, weighted_join

SALTS = 64
WHITE = " \t\n\x0b\x0c\r"
# Order number: code points, then 2^65 places for the id, then 2^30 for the checksum.
ID_PLACES, SUM_PLACES = 1 << 65, 1 << 30
TOP_ID = (1 << 63) - 1


def sha256(norm: Column) -> Column:
    return F.unhex(F.sha2(F.encode(norm, "UTF-8"), 256))


def _big(value: int) -> Column:
    return F.lit(str(value)).cast(f"decimal({len(str(value))},0)")


def order_number(doc_id: Column, text: Column) -> Column:
    """The larger, the better: code points of the text, then the smaller id, then a checksum."""
    place = F.coalesce(_big(TOP_ID) - doc_id.cast("decimal(20,0)") + 1, F.lit(0).cast("decimal(21,0)"))
    check = F.shiftright(F.crc32(F.encode(text, "UTF-8")), 2)
    return ((F.length(text).cast("decimal(10,0)") * _big(ID_PLACES) + place).cast("decimal(29,0)") * F.lit(SUM_PLACES)
            + check.cast("decimal(10,0)")).cast("decimal(38,0)")


def id_of(order: Column) -> Column:
    """The id inside an order number; null where there was none."""
    tail = (order % _big(ID_PLACES * SUM_PLACES)).cast("decimal(29,0)")
    place = ((tail - tail % F.lit(SUM_PLACES)) / F.lit(SUM_PLACES)).cast("decimal(21,0)")
    return F.when(place > 0, (_big(TOP_ID) + 1 - place).cast("long"))


def _winners(rows: DataFrame, salts: int) -> DataFrame:
    """One row per distinct text: digest, norm, best order number and number of rows."""
    salted = rows.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
    merged = salted.groupBy("digest", "salt", "norm").agg(
        F.max("order").alias("order"), F.count(F.lit(1)).alias("n"))
    # All salts of a digest meet in one task, so the second aggregation needs no shuffle of its own.
    return merged.repartition("digest").groupBy("digest", "norm").agg(
        F.max("order").alias("best"), F.sum("n").alias("group_size"))


def _grouped(numbered: DataFrame, salts: int, digest: Callable[[Column], Column]) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    full = numbered.select("row", "doc_id", order_number(F.col("doc_id"), text).alias("order"),
                           F.translate(text, WHITE, "").alias("norm")).withColumn("digest", digest(F.col("norm")))
    by_digest = Window.partitionBy("digest")
    winners = table(_winners(full, salts).drop("norm").withColumn("texts", F.count(F.lit(1)).over(by_digest)), "winners")
    shared = winners.where("texts > 1").select("digest").distinct()
    plain = full.withColumn("variant", F.lit(0))
    single = winners.where("texts = 1").withColumn("variant", F.lit(0)).drop("texts")
    if shared.limit(1).count():
        # Different texts under one digest: told apart by the texts themselves.
        shared = table(shared, "shared")
        mixed = full.join(shared, "digest", "left_semi")
        number = F.row_number().over(by_digest.orderBy("norm"))
        several = table(_winners(mixed, salts).withColumn("variant", number), "texts")
        told = weighted_join(mixed, several.select("digest", "norm", "variant", "group_size"), ["digest", "norm"],
                             "group_size", mixed.count())
        plain = full.join(shared, "digest", "left_anti").withColumn("variant", F.lit(0)).unionByName(told)
        single = single.unionByName(several.drop("norm"))
    rows = table(plain.select("row", "doc_id", "digest", "variant", "order"), "rows")
    key = ["digest", "variant"]
    # Rows that tie in everything: the first one read.
    first = rows.groupBy(*key, F.col("order").alias("best")).agg(F.min("row").alias("first"))
    best = single.join(first, [*key, "best"]).withColumn("load", F.col("group_size"))
    joined = weighted_join(rows.drop("order"), best, key, "load", rows.count())
    return joined.select("row", "doc_id", id_of(F.col("best")).alias("keep_id"), "group_size",
                         (F.col("row") == F.col("first")).alias("kept"), "digest")


def groups(docs: DataFrame, *, salts: int = SALTS, digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """One row per row of ``docs``: the id that stays, the group's size, whether this row stays, the digest."""
    numbered = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                           F.col("text").cast("string").alias("text"))
    return _grouped(numbered, salts, digest).drop("row")


def deduplicate(docs: DataFrame, *, salts: int = SALTS, digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """The rows of ``docs`` that stay, one of each text, with all their columns."""
    numbered = table(docs.select(F.monotonically_increasing_id().alias("row"), F.struct(*docs.columns).alias("doc")), "numbered")
    plain = numbered.select("row", F.col("doc.doc_id").cast("long").alias("doc_id"),
                            F.col("doc.text").cast("string").alias("text"))
    stays = _grouped(plain, salts, digest).where("kept").select("row")
    return numbered.join(stays, "row", "left_semi").select("doc.*")

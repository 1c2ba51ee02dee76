"""Mixing sources to target weights by iterative proportional fitting.

Documents are summed to cells of (source, language, topic) with their token counts.  Raking
finds a factor for every source, language and topic so that the weighted tokens of each match
its target share.  A document then has the probability of its cell, scaled to the token
budget and capped at one, and is kept if a hash of its id falls below it.

Cells are counted with a combine before the shuffle, so a source with a third of all rows
costs a row per task.  Sources may be many: their factors stay on Spark, one row per source
with its (language, topic) entries.  Of languages and topics only the factors come to the
driver, one small query per half sweep; beyond ``max_values`` of either, every factor stays
on Spark and the weighted cells are written once per half sweep, with the same result.
Raking that has not settled after ``max_sweeps`` warns and says by how much.

Tokens are a quarter of a text's UTF-8 bytes, rounded up, so texts without blanks weigh
what they hold.

Targets are given per value, or follow from a power: a value's own token share to that power,
renormalised (below one flattens, one leaves as is).  Where a target cannot be met because
documents would have to be taken more than once, the cell's probability stays at one.

Defined results: a null source, language or topic is a value of its own; null and empty
texts count as one token; repeated rows with equal ids are kept or dropped together; an
empty table gives no rows.  ``sample`` passes all columns through, whatever their names.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlog.llm.common import packed, ship_package, table, unpacked

NONE = "\x00none"
POWERS = {"source": 0.7, "lang": 0.7, "topic": 0.9}
MAX_BROADCAST_CELLS = 200_000


def topic_of(text: bytes) -> str:
    """Topic of a text by its make-up, for tables without one."""
    n = len(text)
    if n < 200:
        return "fragment"
    if 20 * sum(map(text.count, (b"#", b"*", b"$", b"%", b"&", b"|", b"<", b">"))) > n:
        return "markup"
    if 30 * (text.count(b"!") + text.count(b"?")) > n:
        return "shouting"
    if 80 * text.count(b"\n") > n:
        return "lists"
    return "longform" if n > 10_000 else "prose"


def measured(texts: pd.Series) -> pd.DataFrame:
    """Topic and tokens (one at least) of each text, a token being four bytes."""
    raw = [(t or "").encode() for t in texts]
    return pd.DataFrame({"topic": [topic_of(t) for t in raw], "tokens": [max((len(t) + 3) // 4, 1) for t in raw]})


def with_cells(docs: DataFrame, source: Column | None = None, lang: Column | None = None,
               topic: Column | None = None) -> DataFrame:
    """The documents with ``_cell``: their source, language, topic and tokens."""
    ship_package(docs.sparkSession)

    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        yield from map(measured, parts)

    seen = F.pandas_udf(run, "topic string, tokens long")(F.col("text").cast("string"))

    def named(value: Column) -> Column:
        return F.coalesce(value.cast("string"), F.lit(NONE))

    marked = docs.withColumn("_seen", seen)
    return marked.withColumn("_cell", F.struct(
        named(F.col("source") if source is None else source).alias("source"),
        named(F.col("lang") if lang is None else lang).alias("lang"),
        named(F.col("_seen.topic") if topic is None else topic).alias("topic"),
        F.col("_seen.tokens").alias("tokens"))).drop("_seen")


def _shares(sums: dict[str, float], power: float, given: dict[str, float] | None) -> dict[str, float]:
    raw = {k: given.get(k, 0.0) if given else v ** power for k, v in sums.items()}
    total = sum(raw.values()) or 1.0
    return {k: v / total for k, v in raw.items()}


def _factor(values: dict[str, float], key: Column) -> Column:
    pairs = [F.lit(x) for pair in values.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), key), F.lit(0.0)) if pairs else F.lit(0.0)


def _unsettled(sweeps: int, moved: float) -> None:
    warnings.warn(f"raking still moved a factor by {moved:.2g} in the last of {sweeps} sweeps", RuntimeWarning, stacklevel=3)


def _goals(cells: DataFrame, key: str, power: float, given: dict[str, float] | None, total: float) -> DataFrame:
    """(key, goal) of every value: the tokens its target share asks for."""
    sums = cells.groupBy(key).agg(F.sum("tokens").cast("double").alias("n"))
    if given is None:
        raw = sums.select(key, F.pow("n", F.lit(power)).alias("raw"))
    else:
        asked = cells.sparkSession.createDataFrame(list(given.items()), f"{key} string, raw double")
        raw = sums.select(key).join(asked, key, "left").fillna(0.0, ["raw"])
    whole = raw.agg(F.sum("raw")).first()[0] or 1.0
    return table(raw.select(key, (F.col("raw") * (total / whole)).alias("goal")), "goals")


def _rake_tables(cells: DataFrame, goals: dict[str, DataFrame], max_sweeps: int, tolerance: float) -> DataFrame:
    """The sweeps of :func:`rake` with every factor in a table, for any number of values."""
    rows, moved = cells.select("source", "lang", "topic", "tokens", F.lit(1.0).alias("weight")), 0.0
    for _ in range(max_sweeps):
        moved = 0.0
        for key in ("lang", "topic", "source"):
            mass = rows.groupBy(key).agg(F.sum(F.col("tokens") * F.col("weight")).alias("n"))
            # A value without weighted tokens keeps its factor; a goal of zero takes the rest out.
            ratios = table(mass.join(goals[key], key).select(
                key, F.when(F.col("n") > 0, F.col("goal") / F.col("n")).otherwise(F.lit(1.0)).alias("_ratio")), "ratios")
            rows = table(rows.join(ratios, key).select(
                "source", "lang", "topic", "tokens", (F.col("weight") * F.col("_ratio")).alias("weight")), "rake")
            if key != "source":
                asked = ratios.where("_ratio > 0").agg(F.max(F.abs(F.col("_ratio") - 1))).first()[0]
                moved = max(moved, asked or 0.0)
        if moved < tolerance:
            break
    else:
        _unsettled(max_sweeps, moved)
    return rows


def rake(cells: DataFrame, *, powers: dict[str, float] | None = None, shares: dict[str, dict[str, float]] | None = None,
         source_shares: DataFrame | None = None, max_sweeps: int = 30, tolerance: float = 1e-6,
         max_values: int = 1000) -> DataFrame:
    """``cells`` (source, lang, topic, tokens; one row each) with ``weight``.

    ``shares`` gives targets of languages and topics, ``source_shares`` (source, share)
    those of sources; where absent, ``powers`` makes them.
    """
    powers, shares = {**POWERS, **(powers or {})}, shares or {}
    per_source = cells.groupBy("source").agg(
        F.sum("tokens").cast("double").alias("_sum"), F.collect_list(F.struct("lang", "topic", "tokens")).alias("entries"))
    if source_shares is None:
        per_source = per_source.withColumn("share", F.pow("_sum", F.lit(powers["source"])))
    else:
        per_source = per_source.join(source_shares.select("source", "share"), "source", "left").fillna(0.0, ["share"])
    per_source = table(per_source, "sources")
    everything = per_source.agg(F.sum("_sum"), F.sum("share")).first()
    if not everything[0]:
        return cells.withColumn("weight", F.lit(1.0))
    total, whole = everything
    goal = F.col("share") * (total / whole) if whole else F.lit(0.0)

    def sums(key: str) -> dict[str, float] | None:
        rows = cells.groupBy(key).agg(F.sum("tokens").cast("double").alias("n")).limit(max_values + 1).collect()
        return {r[0]: r.n for r in rows} if len(rows) <= max_values else None

    own_sums = {k: sums(k) for k in ("lang", "topic")}
    if None in own_sums.values():
        goals = {"source": per_source.select("source", goal.alias("goal"))}
        for key in own_sums:
            goals[key] = _goals(cells, key, powers[key], shares.get(key), total)
        return _rake_tables(cells, goals, max_sweeps, tolerance)
    targets = {k: _shares(v, powers[k], shares.get(k)) for k, v in own_sums.items()}
    factors = {k: dict.fromkeys(t, 1.0) for k, t in targets.items()}

    def mass(entry: Column) -> Column:
        return entry["tokens"] * _factor(factors["lang"], entry["lang"]) * _factor(factors["topic"], entry["topic"])

    def weighted() -> DataFrame:
        own = F.aggregate("entries", F.lit(0.0), lambda t, e: t + mass(e))
        rows = per_source.withColumn("_own", own).withColumn(
            "_a", F.when(F.col("_own") > 0, goal / F.col("_own")).otherwise(0.0))
        return rows.select("source", "_a", F.explode("entries").alias("e"))

    for _ in range(max_sweeps):
        moved = 0.0
        for key in ("lang", "topic"):
            now = {r[0]: r.n for r in weighted().groupBy(F.col(f"e.{key}").alias("k")).agg(
                F.sum(F.col("_a") * mass(F.col("e"))).alias("n")).collect()}
            for value, share in targets[key].items():
                ratio = share * total / now[value] if now.get(value) else 1.0
                factors[key][value] *= ratio
                moved = max(moved, abs(ratio - 1) if share else 0.0)
        if moved < tolerance:
            break
    else:
        _unsettled(max_sweeps, moved)
    return weighted().select(
        "source", "e.lang", "e.topic", "e.tokens",
        (F.col("_a") * _factor(factors["lang"], F.col("e.lang")) * _factor(factors["topic"], F.col("e.topic"))).alias("weight"))


def with_probability(weighted: DataFrame, budget: float) -> DataFrame:
    """Adds ``probability``: the weight times one constant, capped at one.

    The constant makes the expected tokens ``budget`` times all tokens, found by evaluating
    a grid of constants in one query and narrowing it.
    """
    low, high = 1e-6, 1e6
    for _ in range(6):
        grid = [low * (high / low) ** (i / 20) for i in range(21)]
        row = weighted.agg(F.sum("tokens").alias("all"), *[
            F.sum(F.col("tokens") * F.least(F.col("weight") * g, F.lit(1.0))).alias(f"g{i}") for i, g in enumerate(grid)]).first()
        if not row["all"]:
            break
        above = next((i for i in range(21) if row[f"g{i}"] >= budget * row["all"]), 20)
        low, high = grid[max(above - 1, 0)], grid[above]
    return weighted.withColumn("probability", F.least(F.col("weight") * high, F.lit(1.0)))


def chance(doc_id: Column, text: Column, seed: int = 7) -> Column:
    """A number from 0 to 1 that depends on the id alone, or on the text where there is none."""
    drawn = F.xxhash64(F.when(doc_id.isNull(), text).otherwise(F.lit(None).cast("string")), F.lit(seed))
    return F.pmod(F.when(doc_id.isNull(), drawn).otherwise(F.xxhash64(doc_id, F.lit(seed))), F.lit(1 << 53)) / F.lit(float(1 << 53))


def mixed(docs: DataFrame, *, budget: float = 0.5, seed: int = 7, source: Column | None = None,
          lang: Column | None = None, topic: Column | None = None, **targets) -> DataFrame:
    """The documents with ``_cell``, ``_weight``, ``_probability`` and ``_kept``."""
    marked = with_cells(docs, source, lang, topic)
    cells = table(marked.select("_cell.*").groupBy("source", "lang", "topic").agg(F.sum("tokens").alias("tokens")), "cells")
    odds = table(with_probability(rake(cells, **targets), budget), "odds").select(
        F.struct("source", "lang", "topic").alias("_key"), F.col("weight").alias("_weight"),
        F.col("probability").alias("_probability"))
    if odds.count() <= MAX_BROADCAST_CELLS:
        odds = F.broadcast(odds)
    key = F.struct("_cell.source", "_cell.lang", "_cell.topic")
    return marked.join(odds, key == F.col("_key"), "left").drop("_key").withColumn(
        "_kept", chance(F.col("doc_id"), F.col("text").cast("string"), seed) < F.col("_probability"))


def sample(docs: DataFrame, **options) -> DataFrame:
    """The documents drawn to the target mix, with their own columns, whatever their names."""
    given = {k: options.pop(k, None) for k in ("source", "lang", "topic")}
    columns = {k: F.col(k) if v is None else v for k, v in given.items() if v is not None or k in docs.columns and k != "topic"}
    whole = packed(docs, doc_id=F.col("doc_id"), text=F.col("text").cast("string"), **columns)
    chosen = {k: F.col(k) for k, v in given.items() if v is not None}
    return unpacked(mixed(whole, **chosen, **options).where("_kept"), docs)

"""Keyed upserts of a dimension as one full outer join."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _paired(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer join with each side as a struct column, null when that side is absent."""
    old = target.select(*keys, F.struct(*target.columns).alias("old"))
    new = source.select(*keys, F.struct(*source.columns).alias("new"))
    return old.join(new, list(keys), "full_outer")


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    immutable: Sequence[str] = (),
    earliest: Sequence[str] = (),
    update: Sequence[str] | None = None,
) -> DataFrame:
    """Target after merging the source by key.

    Matched rows take the source values, except ``immutable`` columns, which keep the
    target value, and ``earliest`` columns, which take the smaller one.  ``update`` limits
    what is taken at all.  Unmatched source rows are inserted, unmatched target rows stay.
    Source keys must be unique (see :func:`duplicate_keys`).
    """
    fixed = set(immutable)
    if update is not None:
        fixed |= set(target.columns) - set(update) - set(keys) - set(earliest)
    matched = F.col("old").isNotNull() & F.col("new").isNotNull()

    def merged(name: str) -> Column:
        if name in keys:
            return F.col(name)
        old = F.col(f"old.{name}")
        if name not in source.columns:
            return old.alias(name)
        new = F.col(f"new.{name}")
        if name in earliest:
            value = F.least(old, new)
        elif name in fixed:
            value = F.when(F.col("old").isNotNull(), old).otherwise(new)
        else:
            value = F.when(matched | F.col("old").isNull(), new).otherwise(old)
        return value.alias(name)

    return _paired(target, source, keys).select(*[merged(c) for c in target.columns])


def upsert_dim_player(target: DataFrame, source: DataFrame, first_seen: str = "immutable") -> DataFrame:
    """Merge participants: everything is refreshed but the first date.

    ``immutable`` never changes a first date; ``min`` lets a late, older event lower it.
    """
    if first_seen == "immutable":
        return upsert(target, source, ["player_id"], immutable=["first_seen_date"])
    if first_seen == "min":
        return upsert(target, source, ["player_id"], earliest=["first_seen_date"])
    raise ValueError(f"first_seen must be 'immutable' or 'min', not {first_seen!r}")


def upsert_dim_raid(target: DataFrame, source: DataFrame) -> DataFrame:
    """Merge raids: everything is refreshed but the event date."""
    return upsert(target, source, ["raid_id"], immutable=["event_date"])


def accumulate_dim_player(target: DataFrame, source: DataFrame) -> DataFrame:
    """Merge participants of a new, disjoint load.

    Known labels win, dates widen, raid counts add up.  Not idempotent by design: feed
    each load once.
    """
    def pick(name: str) -> Column:
        old, new = F.col(f"old.{name}"), F.col(f"new.{name}")
        if name == "first_seen_date":
            value = F.least(old, new)
        elif name == "last_seen_date":
            value = F.greatest(old, new)
        elif name == "total_raids":
            value = F.coalesce(old, F.lit(0)) + F.coalesce(new, F.lit(0))
        else:
            value = F.coalesce(old, new)
        return value.alias(name)

    return _paired(target, source, ["player_id"]).select(
        *[F.col(c) if c == "player_id" else pick(c) for c in target.columns]
    )


def duplicate_keys(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return source.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > 1)

"""Text to typed values, with null for what does not parse.

The conversions are SQL text over a column name: one expression per column keeps building
a plan of some thirty conversions cheap on the driver.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def typed_sql(name: str, have: T.DataType, want: T.DataType) -> str:
    """SQL that turns column ``name`` of type ``have`` into ``want``."""
    if isinstance(want, T.ArrayType):
        items = name if isinstance(have, T.ArrayType) else f"from_json({name}, 'array<string>')"
        # A list without its nulls; anything that is not a list is an empty one.
        return f"coalesce(filter({items}, x -> x IS NOT NULL), CAST(array() AS array<string>))"
    if isinstance(want, T.DoubleType):
        return f"nanvl(try_cast({name} AS double), CAST(NULL AS double))"
    if have == want:
        return name
    if isinstance(want, T.TimestampType):
        # Zoneless stamps stay as they are: the operators take both kinds.
        return name if isinstance(have, T.TimestampNTZType) else f"try_cast({name} AS timestamp)"
    if isinstance(want, T.LongType):
        # "70" and "70.0" are whole; a fractional part does not parse.
        number = f"try_cast({name} AS double)"
        return (
            f"coalesce(try_cast({name} AS bigint), "
            f"if({number} = floor({number}), try_cast({number} AS bigint), NULL))"
        )
    if isinstance(want, T.BooleanType):
        return f"try_cast({name} AS boolean)"
    return f"CAST({name} AS string)"


def clean_tags(value: Column) -> Column:
    """A list without nulls; null becomes an empty list."""
    return F.coalesce(
        F.filter(value, lambda item: item.isNotNull()), F.array().cast("array<string>")
    )


def unknown_if_null(value: Column) -> Column:
    return F.coalesce(value, F.lit("unknown"))

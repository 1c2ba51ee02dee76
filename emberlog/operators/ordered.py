"""Running values over long ordered groups.

A window partitioned by the group alone puts the whole group into one task.  Here the
rows are range-partitioned by (group, order), so a group of any size spreads over many
slices; each slice is scanned by itself and starts from the totals of the slices before
it.  The order must be total (end it with a unique column), because it decides both where
a slice ends and the value of every row.

The sliced rows are written once to the shared folder: the slice number depends on sampled
range bounds and has to be the same for the totals and for the rows.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from emberlog.session import materialise

SLICE = "_slice"


def sliced(frame: DataFrame, group: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Rows with the number of the ordered slice they fall into (written to disk once)."""
    ranged = frame.repartitionByRange(*[F.col(g) for g in group], *order)
    return materialise(ranged.withColumn(SLICE, F.spark_partition_id()), "slices")


def _earlier(group: Sequence[str]) -> W:
    # At most one row per shuffle partition and group.
    return (
        W.partitionBy(*group).orderBy(SLICE).rowsBetween(W.unboundedPreceding, -1)
    )


def _rejoin(rows: DataFrame, per_slice: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per-slice values back on the rows; a null group is a group like any other."""
    right = per_slice.withColumnsRenamed({k: f"_of_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys]
    return rows.join(right, same)


def with_running(
    frame: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    number: str = "seq",
    sums: dict[str, tuple[str, str]] | None = None,
) -> DataFrame:
    """Add the position of each row in its group and running sums.

    ``sums`` maps an output name to (input column, decimal type); decimals keep a running
    sum exact no matter how the slices fall.
    """
    sums = sums or {}
    rows = sliced(frame, group, order)
    totals = rows.groupBy(*group, SLICE).agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.sum(F.col(c).cast(t)).alias(f"_sum_{out}") for out, (c, t) in sums.items()],
    )
    starts = totals.select(
        *group,
        SLICE,
        F.coalesce(F.sum("_rows").over(_earlier(group)), F.lit(0)).alias("_rows_before"),
        *[
            F.coalesce(F.sum(f"_sum_{out}").over(_earlier(group)), F.lit(0).cast(t)).alias(
                f"_before_{out}"
            )
            for out, (_, t) in sums.items()
        ],
    )
    inside = W.partitionBy(*group, SLICE).orderBy(*order)
    upto = inside.rowsBetween(W.unboundedPreceding, W.currentRow)
    joined = _rejoin(rows, starts, [*group, SLICE])
    return joined.select(
        *frame.columns,
        (F.col("_rows_before") + F.row_number().over(inside)).alias(number),
        *[
            (
                F.col(f"_before_{out}")
                + F.coalesce(F.sum(F.col(c).cast(t)).over(upto), F.lit(0).cast(t))
            ).alias(out)
            for out, (c, t) in sums.items()
        ],
    )


def with_previous(
    frame: DataFrame, group: Sequence[str], order: Sequence[Column], column: str, out: str
) -> DataFrame:
    """Add the value ``column`` has in the row before, null for the first of a group."""
    rows = sliced(frame, group, order)
    inside = W.partitionBy(*group, SLICE).orderBy(*order)
    # max_by over the total order finds each slice's last row with a map-side combine.
    ends = rows.groupBy(*group, SLICE).agg(
        F.max_by(F.struct(F.col(column)), F.struct(*order)).alias("_last")
    )
    carried = ends.select(
        *group,
        SLICE,
        F.lag("_last").over(W.partitionBy(*group).orderBy(SLICE)).alias("_carried"),
    )
    joined = _rejoin(rows, carried, [*group, SLICE])
    first = F.row_number().over(inside) == 1
    return joined.select(
        *frame.columns,
        F.when(first, F.col(f"_carried.{column}"))
        .otherwise(F.lag(column).over(inside))
        .alias(out),
    )

"""Bounded retries and delivery totals."""

import time
from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlog.functions.numbers import percent


def deliver(write: Callable[[], int], attempts: int = 3, wait: float = 1.0) -> int:
    """Run an idempotent write, again when it fails, at most ``attempts`` times."""
    for attempt in range(1, attempts + 1):
        try:
            return write()
        except PySparkException:
            if attempt == attempts:
                raise
            time.sleep(wait * attempt)
    raise ValueError("attempts must be at least 1")


def delivery_totals(outcomes: DataFrame) -> DataFrame:
    """Batches delivered and failed, with the success percentage.

    ``outcomes`` has a ``status`` column that is ``accepted`` for a delivered batch.
    """
    ok = F.count_if(F.col("status") == "accepted")
    rows = F.count(F.lit(1))
    return outcomes.agg(
        rows.alias("batches"), ok.alias("delivered"), (rows - ok).alias("failed"),
        percent(ok, rows).alias("success_pct"),
    )

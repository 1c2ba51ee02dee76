"""Keys and ids derived from file paths and event stamps."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from emberlog.constants import BATCH_FILE_PATTERN


def batch_id_of(path: Column, declared: Column | None = None) -> Column:
    """Batch id from the file name, else the declared one, else 8 hex digits of the path's md5."""
    named = F.regexp_extract(path, BATCH_FILE_PATTERN, 1)
    hashed = F.substring(F.md5(path), 1, 8)
    candidates = [F.when(named != "", named), hashed]
    if declared is not None:
        candidates.insert(1, declared)
    return F.coalesce(*candidates)


def path_value(path: Column, key: str) -> Column:
    """Value of a ``key=value`` folder, null when the path has none."""
    value = F.regexp_extract(path, rf"(?:^|/){key}=([^/]+)/", 1)
    return F.when(value != "", value)


def raid_of(path: Column) -> Column:
    """Raid id from ``raid_id=``, the older ``raidid=``, or a plain ``raidNNN`` folder."""
    folder = F.regexp_extract(path, r"(?:^|/)(raid\d+)/[^/]+$", 1)
    return F.coalesce(
        path_value(path, "raid_id"), path_value(path, "raidid"), F.when(folder != "", folder)
    )


def ingest_date_of(stamp: Column) -> Column:
    """Calendar date as the first ten characters of an ISO stamp."""
    return F.substring(stamp, 1, 10)


def bronze_key(raid_id: Column, ingest_date: Column, batch_id: Column) -> Column:
    return F.concat(
        F.lit("raid_id="), raid_id,
        F.lit("/ingest_date="), ingest_date,
        F.lit("/batch_"), batch_id, F.lit(".json"),
    )


def silver_key(raid_id: Column, event_date: Column, batch_id: Column) -> Column:
    return F.concat(
        F.lit("raid_id="), raid_id,
        F.lit("/event_date="), event_date.cast("string"),
        F.lit("/part-"), batch_id, F.lit(".parquet"),
    )


def padded(number: Column, width: int) -> Column:
    """A number as text with leading zeros; longer numbers keep all their digits."""
    text = number.cast("string")
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


def chunk_file_name(raid_id: Column, chunk: Column) -> Column:
    """File name of one replay chunk with a zero-padded index."""
    return F.concat(raid_id, F.lit("_batch_"), padded(chunk, 4), F.lit(".json"))


def chunk_number(batch_id: Column) -> Column:
    """Index of a replay chunk as a number, from its batch id."""
    return F.regexp_extract(batch_id, r"_batch_(\d+)$", 1).try_cast("bigint")


def derived_id(*parts: Column) -> Column:
    """Repeatable id in UUID layout from the given values."""
    digest = F.md5(F.concat_ws("\u0001", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))
    return F.concat_ws(
        "-",
        F.substring(digest, 1, 8),
        F.substring(digest, 9, 4),
        F.substring(digest, 13, 4),
        F.substring(digest, 17, 4),
        F.substring(digest, 21, 12),
    )

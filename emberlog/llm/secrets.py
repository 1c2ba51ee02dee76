"""Secret scan with corpus-wide ownership frequency.

Candidates are the values of three base patterns and of long mixed tokens.  Their hashes are
counted over the whole corpus by distinct repositories and owners.  A value is a copied example
if more than ``max_owners`` owners carry it, or more than ``max_repos`` repositories, be they of
one owner; else it is likely live.  One document copied to a second owner thus does not hide
its credential, and a value spread over all repositories of an owner is an example.  Base
spans are always reported; a mixed token is reported (kind ``live``) only if it is live.

Counting first removes repeats inside a task, then (hash, repository, owner) is made distinct
with a combine before the shuffle, so a value in a third of all rows costs a row per task.

Defined results: null and empty texts have no spans; a null owner or repository counts as
the owner or repository named by an empty text; repeated rows each get their own result.
Columns other than id, text and the owner and repository are passed by, whatever their names.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlog.llm.common import batch_of, map_arrow, packed, pieces_of, table, unpacked

# Kinds in listing order, and the base patterns.
KINDS = ("assign", "access", "hex", "live")
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
MIXED = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
MIN_VALUE, MIN_ACCESS = 6, 20
MIN_ENTROPY = 3.5


def entropy(value: str) -> float:
    """Bits per character of the value's own character frequencies."""
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values())


def base_spans(text: str) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, value) of the base matches, by start and then kind."""
    found = [("assign", *m.span(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_VALUE]
    found += [("access", *m.span(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= MIN_ACCESS]
    found += [("hex", *m.span(), m[0]) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def mixed_spans(text: str, taken: list[tuple[str, int, int, str]]) -> list[tuple[str, int, int, str]]:
    """Long tokens of letters of both cases and digits with high entropy, outside base spans."""
    found = []
    for m in MIXED.finditer(text):
        value = m[0]
        if (value.lower() == value or value.upper() == value or not any(map(str.isdigit, value))
                or entropy(value) < MIN_ENTROPY or any(s < m.end() and m.start() < e for _, s, e, _ in taken)):
            continue
        found.append(("live", *m.span(), value))
    return found


def joined(spans) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e, *_ in sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]))))


SCAN = pa.schema([
    ("doc_id", pa.int64()), ("text_crc32", pa.int64()), ("repo", pa.string()), ("owner", pa.string()),
    ("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()), ("base_sha256", pa.string()),
    ("found", pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64()),
                                  ("hash", pa.string())]))),
])


def _scan(batches):
    for batch in batches:
        for part in pieces_of(batch, "text"):
            counts, digests, found, sums = {k: [] for k in KINDS[:3]}, [], [], []
            for text in part["text"].to_pylist():
                sums.append(zlib.crc32((text or "").encode()))
                base = base_spans(text or "")
                for kind, all_of_kind in counts.items():
                    all_of_kind.append(sum(s[0] == kind for s in base))
                digests.append(hashlib.sha256(joined(base).encode()).hexdigest())
                found.append([{"kind": k, "start": s, "stop": e, "hash": hashlib.sha256(v.encode()).hexdigest()}
                              for k, s, e, v in [*base, *mixed_spans(text or "", base)]])
            yield batch_of({
                "doc_id": part["doc_id"], "text_crc32": sums, "repo": part["repo"], "owner": part["owner"], "n_assign": counts["assign"],
                "n_access": counts["access"], "n_hex": counts["hex"], "base_sha256": digests, "found": found}, SCAN)


def ownership(found: DataFrame) -> DataFrame:
    """Per candidate hash: how many distinct repositories and owners carry it."""
    distinct = found.select("hash", "repo", "owner").distinct()
    return distinct.groupBy("hash").agg(
        F.count_distinct("repo").alias("repos"), F.count_distinct("owner").alias("owners"))


def find_secrets(docs: DataFrame, *, owner: Column | None = None, repo: Column | None = None,
                 max_owners: int = 2, max_repos: int = 4) -> DataFrame:
    """Spans of every document with the ownership of each value.

    ``spans`` is an array of (kind, start, stop, hash, repos, owners, live) by start;
    positions are code points, the end exclusive.  A value is live if at most
    ``max_owners`` owners and ``max_repos`` repositories carry it.  Default owner: ``source``; default repository: source
    and language together.
    """
    owner = F.col("source") if owner is None else owner
    repo = F.concat_ws("/", F.col("source"), F.col("lang")) if repo is None else repo
    source = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
        F.coalesce(repo.cast("string"), F.lit("")).alias("repo"),
        F.coalesce(owner.cast("string"), F.lit("")).alias("owner"))
    scanned = map_arrow(
        source, _scan, "doc_id long, text_crc32 long, repo string, owner string, n_assign long, n_access long, n_hex long, "
        "base_sha256 string, found array<struct<kind:string,start:bigint,stop:bigint,hash:string>>")
    # Written once: the row key has to be the same in both uses.
    scanned = table(scanned.withColumn("_row", F.monotonically_increasing_id()), "secrets")
    found = scanned.select("_row", "repo", "owner", F.explode("found").alias("f")).select("_row", "repo", "owner", "f.*")
    owned = found.join(ownership(found), "hash").withColumn(
        "live", (F.col("owners") <= max_owners) & (F.col("repos") <= max_repos))
    # A text's spans are bounded by its length.
    spans = owned.where((F.col("kind") != "live") | F.col("live")).groupBy("_row").agg(F.sort_array(F.collect_list(
        F.struct("start", F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).alias("rank"),
                 "kind", "stop", "hash", "repos", "owners", "live"))).alias("spans"))
    return scanned.drop("found").join(spans, "_row", "left").withColumn("spans", F.coalesce("spans", F.array().cast(
        "array<struct<start:bigint,rank:bigint,kind:string,stop:bigint,hash:string,repos:bigint,owners:bigint,"
        "live:boolean>>")))


def redact(docs: DataFrame, *, max_broadcast: int = 20_000, **options) -> DataFrame:
    """The documents with the live secrets of their texts replaced by ``[kind]``.

    Keeps every row and column, whatever their names; ``n_chars`` follows the new text where
    present.  Widely copied examples stay.  Rows are matched by 64 bits of id and text: rows
    that share them have the same text, hence the same spans.
    """
    key = F.xxhash64(F.col("doc_id"), F.col("text").cast("string"))
    found = find_secrets(docs.withColumn("doc_id", key), **options)
    spans = found.where(F.exists("spans", lambda s: s["live"])).select(
        F.col("doc_id").alias("key"), "spans").dropDuplicates(["key"])
    # Few documents hold live secrets; where they are few enough, texts need no shuffle.
    spans = table(spans, "live")
    if spans.limit(max_broadcast + 1).count() <= max_broadcast:
        spans = F.broadcast(spans)
    joined = packed(docs, key=key, text=F.col("text").cast("string")).join(spans, "key", "left")

    def step(state: Column, s: Column) -> Column:
        between = F.substring(F.col("text"), (state["at"] + 1).cast("int"), (s["start"] - state["at"]).cast("int"))
        return F.when(s["live"] & (s["start"] >= state["at"]), F.struct(
            F.concat(state["out"], between, F.lit("["), s["kind"], F.lit("]")).alias("out"), s["stop"].alias("at"))).otherwise(state)

    merged = F.aggregate(
        F.array_sort(F.col("spans")),
        F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at")), step,
        lambda s: F.concat(s["out"], F.substring(F.col("text"), (s["at"] + 1).cast("int"), F.length("text"))))
    out = joined.withColumn("clean", F.when(F.col("spans").isNull(), F.col("text")).otherwise(merged))
    replaced = {"text": F.col("clean")}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        replaced["n_chars"] = F.when(F.col("spans").isNull(), F.col("doc").getField("n_chars")).otherwise(F.length("clean").cast(kind))
    return unpacked(out, docs, **replaced)

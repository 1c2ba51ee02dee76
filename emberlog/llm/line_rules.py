"""Line-first cleaning: rules judge single lines; a document that loses too much text goes.

Every line is judged by punctuation, navigation and boilerplate rules.  Lines that fail are
removed; the document is rejected when the removed lines held more than ``max_lost`` of its
words, or when it fails the whole-text rules (too few words, too much repetition).

Boilerplate has no language: besides a few fixed phrases, a line of 4 to 40 words is
boilerplate if it recurs in changing surroundings, that is, it stands after (or before)
other lines ten times or more, none of which makes up more than a tenth of them.  A line and
its neighbour count once for each distinct text, whatever its copies.  Lines that
recur because their documents are copies or near copies stand beside the same lines again and
again, and stay.  Of a recurring block the first and last lines are found this way.  The
count covers all documents: lines with enough occurrences first (a combine in each task, one
number a row), then the neighbours of those alone, by (line, side, neighbour, text), so a
line on a third of all pages is spread over tasks by its neighbours and combined before its
own total.  Texts get the list of their recurring lines by a join on a 128-bit hash of the
text, broadcast only if it was counted to be small.

Defined results: null and empty texts have zero counts, are ``base_failed`` and not kept,
and their cleaned text is empty.  Repeated rows are judged alike, row by row.  Columns of the
input beyond the id and text are not read, so their names cannot clash.  Texts are processed
whole, one at a time, so a very long text costs its own length only.  Lines count without
the blanks around them; the edge of a text is no neighbour, and blank lines are passed over.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlog.llm.common import batch_of, map_arrow, pieces_of, table
from emberlog.session import small_side

# Fixed values of the rules.
TERMINAL = tuple(".!?…:;\"'»”’)。！？")
BOILERPLATE = (
    "all rights reserved", "cookie policy", "privacy policy", "terms of use", "terms of service",
    "accept cookies", "enable javascript", "lorem ipsum", "subscribe to our newsletter",
    "sign up for our newsletter", "click here to", "powered by wordpress",
)
NAVIGATION = re.compile(r"[|»›>·•]")
SYMBOLS = "#*$%&|<>"
SEPARATORS = "\x20\x09\x0a\x0b\x0c\x0d"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
LINE_WORDS = (4, 40)
MIN_RECURRENCE = 10
MAX_SHARE_PERCENT = 10
MAX_BROADCAST_HASHES = 1 << 20

_MIX = np.uint64(0x9E3779B97F4A7C15)
_BOILER = re.compile("|".join(map(re.escape, BOILERPLATE)))


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words covered by a run of ``window`` words that occurs at least twice in the list."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    ids = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    runs = np.zeros(n, np.uint64)
    for k in range(window):
        runs = runs * _MIX + (ids[k:k + n] ^ (ids[k:k + n] >> np.uint64(29)))
    ordered = np.sort(runs)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    starts = np.flatnonzero(np.isin(runs, twice))
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + window, -1)
    return int(np.count_nonzero(np.cumsum(edges)[:-1] > 0))


def line_hash(line: str) -> int:
    """Signed 64-bit hash of a line without the blanks around it."""
    value = xxhash.xxh3_64_intdigest(line.strip(SEPARATORS).encode("utf-8", "surrogatepass"))
    return value - (1 << 64) if value >> 63 else value


def recurring_candidates(text: str) -> Iterator[tuple[int, int | None, int | None]]:
    """(line, line before, line after) of every line short enough to be boilerplate, as hashes."""
    low, high = LINE_WORDS
    before = here = None
    fits = False
    for line in text.split("\n"):
        n = len(line.encode("utf-8", "surrogatepass").split())
        if not n:
            continue
        after = line_hash(line)
        if fits:
            yield here, before, after
        before, here, fits = here, after, low <= n <= high
    if fits:
        yield here, before, None


def _postings(schema: pa.Schema, rows_of, kept: tuple[str, ...] = ()):
    """Arrow function: the rows that ``rows_of`` makes of each text, after the ``kept`` columns of it."""
    names = [f.name for f in schema]

    def run(batches):
        for batch in batches:
            for part in pieces_of(batch, "text"):
                own = zip(*(part[c].to_pylist() for c in kept), strict=True) if kept else [()] * part.num_rows
                rows = [(*k, *row) for k, text in zip(own, part["text"].to_pylist(), strict=True) for row in rows_of(text)]
                columns = zip(*rows, strict=True) if rows else [()] * len(names)
                yield batch_of(dict(zip(names, columns, strict=True)), schema)

    return run


def recurring_lines(texts: DataFrame, key: str, *, least: int = MIN_RECURRENCE, max_share: int = MAX_SHARE_PERCENT) -> DataFrame:
    """(line) hashes of the lines of ``texts`` (text, not null) that recur in changing surroundings.

    ``key`` is a 64-bit column that equal texts share.
    """
    long = pa.int64()
    lines = map_arrow(texts.select("text"), _postings(pa.schema([("line", long)]), lambda t: ((h,) for h, _, _ in recurring_candidates(t))),
                      "line long")
    often = small_side(lines.groupBy("line").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least).select("line"),
                       "often")

    def beside(text):
        for here, before, after in recurring_candidates(text):
            if before is not None:
                yield here, 0, before
            if after is not None:
                yield here, 1, after

    schema = pa.schema([("key", long), ("line", long), ("side", pa.int32()), ("other", long)])
    pairs = map_arrow(texts.select(F.col(key).alias("key"), "text"), _postings(schema, beside, ("key",)),
                      "key long, line long, side int, other long").join(often, "line", "left_semi")
    once = pairs.groupBy("line", "side", "other", "key").agg(F.lit(1).alias("one"))
    counts = once.groupBy("line", "side", "other").agg(F.count("one").alias("n"))
    sides = counts.groupBy("line", "side").agg(F.sum("n").alias("n"), F.max("n").alias("most"))
    varied = (F.col("n") >= least) & (100 * F.col("most") <= max_share * F.col("n"))
    return table(sides.where(varied).select("line").distinct(), "recurring")


def line_fault(line: str, words: list[bytes], recurring: frozenset[int] = frozenset()) -> str:
    """Name of the first rule the line breaks; empty if it is fine or has no word.

    ``recurring``: hashes of lines that recur over the corpus.
    """
    n = len(words)
    if not n:
        return ""
    marks = len(NAVIGATION.findall(line))
    if marks >= 2 and 4 * marks >= n:
        return "navigation"
    symbols = sum(map(line.count, SYMBOLS))
    if n >= 3 and symbols >= n:
        return "punctuation"
    shouts = line.count("!") + line.count("?")
    if n >= 4 and shouts > n:
        return "punctuation"
    body = line.rstrip(SEPARATORS)
    if n < 4 and not body.endswith(TERMINAL) and "," not in body and (line.istitle() or line.isupper()):
        return "navigation"
    if n <= 40 and _BOILER.search(line.lower()):
        return "boilerplate"
    if recurring and LINE_WORDS[0] <= n <= LINE_WORDS[1] and line_hash(line) in recurring:
        return "recurring"
    return ""


def judge(text: str, max_lost: float, recurring: frozenset[int] = frozenset()) -> tuple:
    """Counts, verdict and cleaned text of one document."""
    words = text.encode("utf-8", "surrogatepass").split()
    n_words = len(words)
    word_chars = len(text) - sum(map(text.count, SEPARATORS))
    n_symbols = sum(map(text.count, SYMBOLS))
    seen: set[str] = set()
    kept, lost, duplicates = [], 0, 0
    faults = {"punctuation": 0, "navigation": 0, "boilerplate": 0, "recurring": 0}
    for line in text.split("\n"):
        own = line.encode("utf-8", "surrogatepass").split()
        if own:
            if line in seen:
                duplicates += 1
            else:
                seen.add(line)
        fault = line_fault(line, own, recurring)
        if fault:
            faults[fault] += 1
            lost += len(own)
        else:
            kept.append(line)
    repeats = repeated_words(words)
    failed = n_words < MIN_WORDS or 100 * repeats > MAX_REPEAT_PERCENT * n_words
    keep = not failed and lost <= max_lost * n_words
    return (n_words, word_chars, n_symbols, duplicates, repeats, failed, keep,
            faults["punctuation"], faults["navigation"], faults["boilerplate"] + faults["recurring"],
            faults["recurring"], lost, "\n".join(kept))


FIELDS = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, kept boolean, n_punctuation_lines long, n_navigation_lines long, "
          "n_boilerplate_lines long, n_recurring_lines long, n_lost_words long, clean_text string")
_ARROW = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.int64()] * 5 + [pa.string()]


def clean_lines(docs: DataFrame, *, max_lost: float = 0.5, with_text: bool = True,
                least: int = MIN_RECURRENCE, max_share: int = MAX_SHARE_PERCENT) -> DataFrame:
    """One row per document: counts, verdict, and the text without its failing lines.

    ``least`` and ``max_share``: how often a line recurs at least, and how much of that, in
    percent, may be beside one and the same line.  ``n_recurring_lines`` are those of
    ``n_boilerplate_lines`` that the corpus names.  ``with_text=False`` leaves the cleaned
    text out.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    keys = ["key1", "key2"]
    keyed = source.withColumns({k: F.xxhash64("text", F.lit(i)) for i, k in enumerate(keys)})
    known = recurring_lines(keyed, keys[0], least=least, max_share=max_share)
    hashes = pa.schema([(k, pa.int64()) for k in (*keys, "line")])
    found = map_arrow(keyed.select(*keys, "text"), _postings(hashes, lambda t: ((h,) for h, _, _ in recurring_candidates(t)), tuple(keys)),
                      "key1 long, key2 long, line long")
    # A text's own lines at most; equal texts are one key.
    per_text = table(found.join(small_side(known, "known"), "line", "left_semi").groupBy(*keys).agg(
        F.collect_set("line").alias("lines")), "per_text")
    held = per_text.agg(F.sum(F.size("lines").cast("long") + len(keys))).first()[0] or 0
    if held <= MAX_BROADCAST_HASHES:
        per_text = F.broadcast(per_text)
    names = [f.strip().split()[0] for f in FIELDS.split(",")]
    schema = pa.schema([("doc_id", pa.int64()), *zip(names, _ARROW, strict=True)])
    fields = FIELDS
    if not with_text:
        schema = schema.remove(len(schema) - 1)
        fields = FIELDS.rpartition(",")[0]

    def run(batches):
        for batch in batches:
            for part in pieces_of(batch, "text"):
                rows = [judge(t, max_lost, frozenset(lines or ())) for t, lines in zip(
                    part["text"].to_pylist(), part["lines"].to_pylist(), strict=True)]
                columns = dict(zip(names, zip(*rows, strict=True), strict=True)) if rows else dict.fromkeys(names, ())
                yield batch_of({"doc_id": part["doc_id"], **columns}, schema)

    judged = keyed.join(per_text, keys, "left").select("doc_id", "text", "lines")
    return map_arrow(judged, run, f"doc_id long, {fields}")

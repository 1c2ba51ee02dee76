"""Toxicity by maximum-scoring segments of token log-odds.

Training counts, for words and their leading letters, in how many labelled toxic and clean
texts each occurs.  With a Dirichlet prior added to both counts, a feature's score is its
log-odds less two posterior standard deviations; only features clearly on the toxic side keep
one.  In a text each word scores its best feature and every other word a small loss, so the
expected score of clean text is negative, and one linear scan finds all maximal segments
(each the best-scoring passage of its neighbourhood).  A segment's significance follows the
extreme-value law of such scans: E = K n exp(-lambda S), with lambda and K taken from clean
texts.  A text's evidence is the extreme-value surprise of its segments, and a logistic
curve fitted on the training rows turns it into a score from 0 to 1.

The training sample is bounded: ``max_training`` labelled ids, chosen by a hash.  Its texts are
written once, and the feature table comes from them alone; a feature needs ``min_texts`` toxic
texts, as rarer ones say more about one text than about toxicity.  Everything else reads all
rows and whole texts.

Defined results: null and empty texts have no segment and get the score of no evidence;
repeated rows score alike; unlabelled documents score like others; an id with labels that
disagree is toxic, and texts that share a labelled id all train; without usable labels every
score is 0.  Only doc_id and text of the documents are read, and only doc_id and the
label column of the labels.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlog.llm.common import batch_of, held_out, map_arrow, pieces_of, ship_package, table

WORD = re.compile(r"\w+")
STEMS = (3, 4, 5, 6)
PRIOR = 0.5
LOSS = 0.1
FLUSH = 400_000


@dataclass
class Model:
    """Feature scores, extreme-value constants and the logistic curve."""

    scores: dict[str, float] = field(default_factory=dict)
    rate: float = 1.0
    scale: float = 1.0
    curve: tuple[float, ...] = (-50.0, 0.0, 0.0)


def features(word: str) -> list[str]:
    """The word itself, and its leading letters marked as such."""
    return [word, *[word[:n] + "*" for n in STEMS if len(word) >= n]]


def word_scores(words: list[str], known: dict[str, float], memo: dict[str, float]) -> tuple[list[int], list[float]]:
    """Positions and scores of the words that have a scored feature."""
    places, values = [], []
    for i, word in enumerate(words):
        score = memo.get(word)
        if score is None:
            if len(memo) > FLUSH:
                memo.clear()
            score = memo[word] = max((known.get(f, 0.0) for f in features(word)), default=0.0)
        if score:
            places.append(i)
            values.append(score)
    return places, values


def maximal_segments(places: list[int], values: list[float], loss: float = LOSS) -> list[tuple[int, int, float]]:
    """All maximal scoring segments as (first, last, score), in linear time.

    ``places`` are the positions with a positive score; every position between costs
    ``loss``.  Each candidate keeps the running total before (``low``) and after it
    (``high``) and the nearest earlier candidate with a smaller ``low``, so that finding
    where it merges follows links instead of scanning back.
    """
    found: list[list] = []  # [first, last, low, high, link]
    total, at = 0.0, 0
    for place, value in zip(places, values, strict=True):
        total -= loss * (place - at)
        at = place + 1
        first, low = place, total
        total += value
        high = total
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= low:
                j = found[j][4]
            if j < 0 or found[j][3] >= high:
                found.append([first, place, low, high, j])
                break
            first, low = found[j][0], found[j][2]
            del found[j:]
    return [(f, last, high - low) for f, last, low, high, _ in found]


def evidence(segments: list[tuple[int, int, float]], n_words: int, model: Model) -> tuple[float, float]:
    """Surprise of the best segment, and the sum over all that are surprising."""
    if not segments:
        return 0.0, 0.0
    base = math.log(max(model.scale * n_words, 1e-9))
    # -log P(max >= S) under the extreme-value law, from log E
    surprise = [-math.log(-math.expm1(-math.exp(min(base - model.rate * s, 50.0))) or 1e-300) for _, _, s in segments]
    return max(surprise), sum(surprise)


def probability(best: float, total: float, model: Model) -> float:
    a, b, c = model.curve
    x = a + b * math.log1p(best) + c * math.log1p(total)
    return 1 / (1 + math.exp(-max(-60.0, min(60.0, x))))


def _counts(batches):
    """Texts per feature, split by label; repeats within a text count once."""
    schema = pa.schema([("feature", pa.string()), ("toxic", pa.int64()), ("clean", pa.int64())])
    counts = {True: Counter(), False: Counter()}

    def flush():
        keys = list(counts[True].keys() | counts[False].keys())
        out = batch_of({"feature": keys, "toxic": [counts[True][k] for k in keys],
                        "clean": [counts[False][k] for k in keys]}, schema)
        for c in counts.values():
            c.clear()
        return out

    for batch in batches:
        for part in pieces_of(batch, "text"):
            for text, toxic in zip(part["text"].to_pylist(), part["toxic"].to_pylist(), strict=True):
                counts[toxic].update({f for w in set(WORD.findall((text or "").lower())) for f in features(w)})
            if len(counts[True]) + len(counts[False]) > FLUSH:
                yield flush()
    yield flush()


def fit(docs: DataFrame, labels: DataFrame, *, label: str = "toxic", max_training: int = 100_000,
        min_texts: int = 3, min_score: float = 1.0) -> Model:
    """Model from the labelled texts outside the held-out fifth.

    Every feature with ``min_texts`` toxic texts and a score above ``min_score`` is kept.
    """
    chosen = labels.select(F.col("doc_id").alias("_id"), (F.col(label) == 1).alias("toxic")).where(
        F.col("_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out("_id")).groupBy("_id").agg(F.max("toxic").alias("toxic"))
    chosen = chosen.orderBy(F.xxhash64("_id"), "_id").limit(max_training)
    # Bounded by max_training rows of an id and a flag.
    texts = docs.select(F.col("doc_id").alias("_id"), F.col("text").cast("string").alias("text")).join(
        F.broadcast(chosen), "_id").select("text", "toxic")
    texts = table(texts, "training")
    sizes = {r.toxic: r["count"] for r in texts.groupBy("toxic").count().collect()}
    model = Model()
    if len(sizes) < 2:
        return model
    totals = map_arrow(texts, _counts, "feature string, toxic long, clean long").groupBy("feature").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    t, c = F.col("toxic") + PRIOR, F.col("clean") + PRIOR
    odds = F.ln(t / (sizes[True] + 2 * PRIOR - t)) - F.ln(c / (sizes[False] + 2 * PRIOR - c))
    scored = totals.where(F.col("toxic") >= min_texts).select(
        "feature", (odds - 2 * F.sqrt(1 / t + 1 / c)).alias("score")).where(F.col("score") > min_score)
    # Bounded by the training texts: min_texts of them share each feature.
    model.scores = {r.feature: r.score for r in scored.collect()}
    return calibrate(texts, model)


def _null_shape(known: dict[str, float]):
    """Counts of gains and segment scores (to three digits) over clean texts, and their words."""
    schema = pa.schema([("kind", pa.string()), ("value", pa.float64()), ("n", pa.int64())])

    def run(batches):
        memo, seen = {}, Counter()
        for batch in batches:
            for text in batch["text"]:
                words = WORD.findall((text.as_py() or "").lower())
                places, values = word_scores(words, known, memo)
                seen["words", 0.0] += len(words)
                seen.update(("gain", v) for v in values)
                seen.update(("segment", round(s, 3)) for _, _, s in maximal_segments(places, values))
        yield batch_of({"kind": [k for k, _ in seen], "value": [v for _, v in seen], "n": list(seen.values())}, schema)

    return run


def _text_evidence(model: Model):
    schema = pa.schema([("toxic", pa.bool_()), ("best", pa.float64()), ("total", pa.float64())])

    def run(batches):
        memo = {}
        for batch in batches:
            found = []
            for text in batch["text"]:
                words = WORD.findall((text.as_py() or "").lower())
                found.append(evidence(maximal_segments(*word_scores(words, model.scores, memo)), len(words), model))
            yield batch_of({"toxic": batch["toxic"], "best": [f[0] for f in found], "total": [f[1] for f in found]}, schema)

    return run


def calibrate(texts: DataFrame, model: Model) -> Model:
    """Extreme-value constants from the clean training texts, then the logistic curve.

    The driver gets a count per distinct gain (as many as scores) and rounded segment score,
    then two numbers per training text.
    """
    known = model.scores
    shape = map_arrow(texts.where(~F.col("toxic")).select("text"), _null_shape(known), "kind string, value double, n long")
    rows = shape.groupBy("kind", "value").agg(F.sum("n").alias("n")).orderBy("kind", "value").collect()
    words = sum(r.n for r in rows if r.kind == "words") + 1.0

    def counted(kind: str, least: float) -> tuple[np.ndarray, np.ndarray]:
        own = [(r.value, r.n) for r in rows if r.kind == kind] + [(least, 1)]
        return np.array([v for v, _ in own]), np.array([n for _, n in own], np.float64)

    least = min(known.values(), default=1.0)
    gains, often = counted("gain", least)
    segments, times = counted("segment", least)
    # lambda > 0 solves E exp(lambda s) = 1 for a word of clean text; the mean score is
    # negative and the largest positive, so there is one solution.
    rest = max(words - often.sum(), 1.0)
    low, high = 0.0, 64.0 / float(gains.max())
    for _ in range(80):
        middle = (low + high) / 2
        excess = (often * np.exp(middle * gains)).sum() + rest * math.exp(-middle * LOSS) - (often.sum() + rest)
        low, high = (middle, high) if excess < 0 else (low, middle)
    model.rate = max(high, 0.05)
    # K: how many segments clean text has per word, against exp(-lambda S) at the median score.
    order = np.argsort(segments)
    half = np.searchsorted(np.cumsum(times[order]), times.sum() / 2)
    middle = float(segments[order][half])
    model.scale = float(times[segments >= middle].sum() / (words * math.exp(-model.rate * middle)))
    # A row per training text, of which max_training bounds the ids.
    seen = map_arrow(texts, _text_evidence(model), "toxic boolean, best double, total double").orderBy("toxic", "best", "total").collect()
    x = np.array([[1.0, math.log1p(r.best), math.log1p(r.total)] for r in seen])
    y = np.array([float(r.toxic) for r in seen])
    w = np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (y - p) - 1e-2 * w
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(3)
        step = np.linalg.solve(hessian, gradient)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    model.curve = tuple(map(float, w))
    return model


PASSAGE = "array<struct<start:bigint,stop:bigint,score:double,surprise:double>>"


def score_texts(docs: DataFrame, model: Model) -> DataFrame:
    """Score, verdict and toxic passages (code-point positions) of every document."""
    schema = pa.schema([
        ("doc_id", pa.int64()), ("score", pa.float64()), ("predicted", pa.int32()), ("passages", pa.list_(pa.struct([
            ("start", pa.int64()), ("stop", pa.int64()), ("score", pa.float64()), ("surprise", pa.float64())])))])
    constants = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the training texts

    def run(batches):
        m, memo = constants.value, {}
        for batch in batches:
            for part in pieces_of(batch, "text"):
                scores, passages = [], []
                for text in part["text"].to_pylist():
                    lowered = (text or "").lower()
                    words = WORD.findall(lowered)
                    places, values = word_scores(words, m.scores, memo)
                    segments = maximal_segments(places, values)
                    scores.append(probability(*evidence(segments, len(words), m), m))
                    passages.append(located(text or "", segments, len(words), m))
                yield batch_of({"doc_id": part["doc_id"], "score": scores, "predicted": [int(s >= 0.5) for s in scores],
                                "passages": passages}, schema)

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = map_arrow(source, run, f"doc_id long, score double, predicted int, passages {PASSAGE}")
    return out.withColumn("held_out", F.coalesce(held_out(), F.lit(False)))


def located(text: str, segments: list[tuple[int, int, float]], n_words: int, model: Model) -> list[dict]:
    """Segments that are significant at 5 %, with their place in the text."""
    strong = [(f, last, s, evidence([(f, last, s)], n_words, model)[0]) for f, last, s in segments]
    strong = [x for x in strong if x[3] > 3.0]
    if not strong:
        return []
    spans = [m.span() for m in WORD.finditer(text.lower())]
    return [{"start": spans[f][0], "stop": spans[last][1], "score": s, "surprise": e} for f, last, s, e in strong]


def clean_documents(docs: DataFrame, labels: DataFrame, *, threshold: float = 0.5, **options) -> DataFrame:
    """The documents whose score is below ``threshold``, with all their columns; no shuffle of texts."""
    ship_package(docs.sparkSession)
    constants = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, **options))

    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m, memo = constants.value, {}
        for texts in parts:
            scores = []
            for text in texts:
                words = WORD.findall((text or "").lower())
                segments = maximal_segments(*word_scores(words, m.scores, memo))
                scores.append(probability(*evidence(segments, len(words), m), m))
            yield pd.Series(scores, dtype="float64")

    score = F.pandas_udf(run, "double")
    return docs.where(score(F.col("text").cast("string")) < threshold)


def score_documents(docs: DataFrame, labels: DataFrame, *, labelled: DataFrame | None = None, **options) -> DataFrame:
    """Fits on ``labels`` (texts from ``labelled``, by default the documents) and scores all documents."""
    return score_texts(docs, fit(docs if labelled is None else labelled, labels, **options))

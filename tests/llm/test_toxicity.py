import random
import zlib

import numpy as np

from emberlog.llm import toxicity


def brute_segments(places, values, loss):
    """Maximal segments by their definition: recursively the best-scoring passage, then left and right of it."""
    if not places:
        return []
    scores = np.full(max(places) + 1, -loss)
    scores[places] = values

    def best(a, b):
        if a >= b:
            return []
        top, where = 0.0, None
        for i in range(a, b):
            total = 0.0
            for j in range(i, b):
                total += scores[j]
                if total > top + 1e-9:
                    top, where = total, (i, j)
        if where is None:
            return []
        return best(a, where[0]) + [(*where, round(top, 6))] + best(where[1] + 1, b)

    return best(0, len(scores))


def test_segments_equal_their_definition():
    rng = random.Random(1)
    for _ in range(150):
        places = sorted(rng.sample(range(40), rng.randint(0, 12)))
        values = [rng.choice([0.37, 1.13, 2.71]) + rng.random() for _ in places]
        got = [(f, last, round(s, 6)) for f, last, s in toxicity.maximal_segments(places, values, loss=0.4)]
        assert got == brute_segments(places, values, 0.4)


def made_corpus(spark, n=900):
    rng = random.Random(2)
    words = ["w%d" % i for i in range(300)]
    docs, labels = [], []
    for i in range(n):
        text = [rng.choice(words) for _ in range(rng.randint(20, 120))]
        toxic = rng.random() < 0.3
        for _ in range(rng.randint(2, 6) if toxic else 0):
            text.insert(rng.randrange(len(text)), rng.choice(["vile", "slur", "stem" + rng.choice(words), "STEM" + rng.choice(words)]))
        docs.append((i, " ".join(text), "x"))
        labels.append((i, int(toxic), "y"))
    return (spark.createDataFrame(docs, "doc_id long, text string, score string"),
            spark.createDataFrame(labels, "doc_id long, toxic int, text string"), {i: t for i, t, _ in labels})


def test_held_out_accuracy_and_passages(spark):
    docs, labels, truth = made_corpus(spark)
    rows = toxicity.score_documents(docs, labels).collect()
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0}
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    texts = {r.doc_id: r.text for r in docs.collect()}
    toxic = [r for r in rows if r.passages]
    assert toxic and all(any(w in texts[r.doc_id][p.start:p.stop].lower() for w in ("vile", "slur", "stem"))
                         for r in toxic for p in r.passages if r.predicted)
    kept = toxicity.clean_documents(docs, labels)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in rows if not r.predicted}


def test_labels_of_held_out_rows_change_nothing(spark):
    docs, labels, _ = made_corpus(spark, 300)
    flipped = labels.selectExpr("doc_id", "case when crc32(cast(doc_id as string)) % 5 = 0 then 1 - toxic else toxic end as toxic")
    scores = [sorted((r.doc_id, r.score) for r in toxicity.score_documents(docs, x).collect()) for x in (labels, flipped)]
    assert scores[0] == scores[1]


def test_edge_rows(spark):
    docs, labels, _ = made_corpus(spark, 300)
    more = docs.union(spark.createDataFrame([(1000, None, ""), (1001, "", ""), (None, "vile slur vile slur", ""), (5, "again", "")], docs.schema))
    more_labels = labels.union(spark.createDataFrame([(1000, 1, ""), (None, 1, ""), (1001, None, ""), (3, 1, "")], labels.schema))
    rows = toxicity.score_documents(more, more_labels).collect()
    assert len(rows) == 304
    empty = {r.score for r in rows if r.doc_id in (1000, 1001)}
    assert len(empty) == 1
    assert next(r for r in rows if r.doc_id is None).predicted == 1
    untrained = toxicity.score_documents(docs, labels.where("false")).collect()
    assert {r.predicted for r in untrained} == {0}
    assert toxicity.score_documents(docs.where("false"), labels).count() == 0


def test_labels_that_disagree_count_as_toxic(spark):
    docs, labels, truth = made_corpus(spark, 300)
    settled = labels.selectExpr("doc_id", "greatest(toxic, cast(doc_id % 7 = 0 as int)) as toxic")
    doubled = labels.selectExpr("doc_id", "toxic").union(labels.selectExpr("doc_id", "1 as toxic").where("doc_id % 7 = 0"))
    scores = [sorted((r.doc_id, r.score) for r in toxicity.score_documents(docs, x).collect())
              for x in (settled, doubled, doubled.orderBy("toxic").repartition(7))]
    assert scores[0] == scores[1] == scores[2]


def test_rare_toxic_labels_and_very_long_text(spark):
    rng = random.Random(4)
    words = ["w%d" % i for i in range(400)]
    rows = [(i, " ".join(rng.choices(words, k=40)) + (" vile" if i % 60 == 0 else "")) for i in range(1800)]
    long = " ".join(rng.choices(words, k=400_000))
    rows += [(5000, long), (5001, long + " vile vile vile vile " + long)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 60 == 0)) for i in range(1800)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    assert model.scores["vile"] > 1 and model.rate > 0 and model.scale > 0
    assert toxicity.fit(docs, labels, min_texts=10_000).scores == {}
    got = {r.doc_id: r for r in toxicity.score_documents(docs, labels).collect()}
    assert got[5001].score > got[5000].score and 0 <= got[5000].score <= 1

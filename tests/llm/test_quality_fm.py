import random

import numpy as np
from pyspark.sql import functions as F

from relaymart.llm import quality_fm as q
from tests_llm_rows import MESSY, doc


def corpus_rows(n=500, seed=4):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        good = rng.random() < 0.7
        ws = rng.choices(["plain", "words", "in", "a", "calm", "text"], k=rng.randint(5, 60))
        text = " ".join(ws) + "." if good else " ".join(w.upper() + "!!" for w in ws)
        rows.append(doc(i, text))
        labels.append((i, int(good), 0))
    return rows, labels


def test_pairwise_sum_is_linear_in_the_features():
    m = q.Machine.start()
    m.w = np.random.default_rng(1).normal(size=q.PLACES)
    m.v = np.random.default_rng(2).normal(size=(q.PLACES, q.FACTORS))
    places, x = q.features("Some words, some more words!", 7)
    slow = m.w0 + sum(m.w[i] * a for i, a in zip(places, x)) + sum(
        m.v[places[i]] @ m.v[places[j]] * x[i] * x[j] for i in range(len(x)) for j in range(i + 1, len(x)))
    assert abs(slow - m.margin(places, x)) < 1e-9


def test_held_out_accuracy_and_messy_rows(corpus, spark):
    rows, labels = corpus_rows()
    messy = [(r[0] and r[0] + 10_000, *r[1:]) for r in MESSY]
    labels += [(None, 1, None), (3, None, None)]
    label_table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("text", F.lit("x"))
    docs = corpus(rows + messy).withColumn("label", F.lit(1)).withColumn("score", F.lit(2))
    out = q.classify(docs, label_table).collect()
    assert len(out) == len(rows) + len(messy)
    truth = {i: y for i, y, _ in labels if i is not None and y is not None}
    held = [r for r in out if r.held_out and r.doc_id in truth]
    assert len(held) > 100 and sum(r.predicted == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in out)
    assert not any(r.held_out for r in out if r.doc_id is None)


def test_labels_and_source_are_no_inputs(corpus, spark):
    rows, labels = corpus_rows(120)
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    scores = lambda docs: {r.doc_id: r.score for r in q.classify(docs, table).collect()}
    docs = corpus(rows)
    assert scores(docs) == scores(docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit(None).cast("string")))


def test_scores_by_definition(corpus, spark):
    """Every pair of features summed up, and the logistic of it."""
    import math

    rows, labels = corpus_rows(80)
    rows = rows + [doc(9000, None), doc(9001, ""), doc(9002, "ÄÖ 12 words, and more!")]
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    learnable = ~F.coalesce(q.remainder(F.col("doc_id"), 3) == 1, F.lit(False))
    m = q.learn(corpus(rows), table, learnable)
    by_id = {r[0]: r for r in rows}
    for r in q.classify(corpus(rows), table).collect():
        places, x = q.features(by_id[r.doc_id][1], by_id[r.doc_id][4])
        margin = m.w0 + sum(m.w[i] * a for i, a in zip(places, x)) + sum(
            m.v[places[i]] @ m.v[places[j]] * x[i] * x[j] for i in range(len(x)) for j in range(i + 1, len(x)))
        assert abs(r.score - 1 / (1 + math.exp(-margin))) < 1e-6


def test_labels_that_meet_no_document(corpus, spark):
    table = spark.createDataFrame([(i, i % 2, 0) for i in range(700, 760)], "doc_id long, quality int, toxic int")
    assert {r.score for r in q.classify(corpus([doc(1, "text")]), table).collect()} == {0.5}
    assert q.classify(corpus([]), table).collect() == []


def test_nothing_to_learn_from(corpus, spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in q.classify(corpus(MESSY), none).collect()} == {0.5}
    assert q.classify(corpus([]), none).count() == 0

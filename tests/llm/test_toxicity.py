"""Held-out accuracy, rows kept out of learning, and odd rows."""

import math
from zlib import crc32

import numpy as np
from partflow.llm import toxicity


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{name}.parquet") for name in ("documents", "labels"))
    scored = toxicity.score_toxicity(docs, labels).join(labels, "doc_id").where("held_out").collect()
    toxic = [row for row in scored if row.toxic]
    caught = sum(row.predicted for row in toxic)
    wrong = sum(row.predicted for row in scored if not row.toxic)
    assert caught >= 0.75 * len(toxic) and wrong <= 0.01 * len(scored)
    assert all(0 <= row.score <= 1 and row.predicted == int(row.score >= 0.5) for row in scored)


def test_fold_and_odd_rows(spark, odd_docs, odd_rows):
    labels = spark.createDataFrame([(1, 0, 0, "x"), (2, 0, 0, "x"), (2, 0, 1, "x"), (None, 0, 1, "x"), (6, 0, None, "x"), (99, 0, 1, "x")],
                                   "doc_id long, quality int, toxic int, text string")
    learned = {(row.doc_id, row.label) for row in toxicity.learning_rows(odd_docs, labels).collect()}
    assert learned <= {(1, 0), (2, 1)} and all(crc32(str(doc_id).encode()) % 5 for doc_id, _ in learned)
    rows = toxicity.score_toxicity(odd_docs, labels).collect()
    assert len(rows) == len(odd_rows)
    for row in rows:
        assert 0 <= row.score <= 1
        assert row.held_out == (row.doc_id is None or crc32(str(row.doc_id).encode()) % 5 == 0)
    kept = toxicity.keep_clean(odd_docs, labels)
    assert kept.columns == odd_docs.columns


def test_no_labels(spark, odd_docs, odd_rows):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = toxicity.score_toxicity(odd_docs, labels).collect()
    assert all(abs(row.score - 1 / 3) < 1e-12 and row.predicted == 0 for row in rows) and len(rows) == len(odd_rows)
    assert toxicity.keep_clean(odd_docs, labels).count() == len(odd_rows)
    assert toxicity.score_toxicity(odd_docs.where("false"), labels).count() == 0


def test_without_evidence_nothing_is_toxic(spark, make_docs):
    words = ["apple", "pear", "plum", "fig"]
    rows = [(n, f"{words[n % 4]} {words[n // 4 % 4]} {words[n // 16]}", "s") for n in range(60)]
    rows += [(100, "", "s"), (101, None, "s"), (102, "ganz andere sprache", "s")]
    docs = make_docs(rows)
    few = [n for n in range(60) if crc32(str(n).encode()) % 5][:3]
    for labels in ([], [(few[0], 0, 1)], [(n, 0, 1) for n in few], [(few[0], 0, 1), (few[1], 0, 0)],
                   [(n, 0, n % 2) for n in range(60)], [(n, 0, 1) for n in range(60)]):
        frame = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
        predicted = {row.doc_id: row.predicted for row in toxicity.score_toxicity(docs, frame).collect()}
        kept = {row.doc_id for row in toxicity.keep_clean(docs, frame).collect()}
        assert kept == {doc_id for doc_id, toxic in predicted.items() if not toxic}
        ones = sum(toxic for _, _, toxic in labels)
        if not ones:
            assert kept == {doc_id for doc_id, _, _ in rows}
        if ones == len(labels) == 60:
            assert not kept & {100, 101, 102}


def test_a_score_of_one_half_is_toxic(spark, make_docs):
    weights = spark.createDataFrame([(1 << toxicity.BITS, 0.0)], "place long, weight double")
    assert [row.score for row in toxicity.score(make_docs([(1, "", "s")]).select("doc_id", "text"), weights).collect()] == [0.5]
    # One label of 1 on a text without words starts from (1 + 1) / (3 + 1).
    docs = make_docs([(n, "", "s") for n in range(9)])
    one = next(n for n in range(9) if crc32(str(n).encode()) % 5)
    labels = spark.createDataFrame([(one, 0, 1)], "doc_id long, quality int, toxic int")
    found = toxicity.score_toxicity(docs, labels).collect()
    assert all(row.score >= 0.5 and row.predicted == 1 for row in found)
    assert toxicity.keep_clean(docs, labels).count() == 0


def plain_ftrl(rows, epochs, alpha, beta, l1, l2):
    """The method with dictionaries, coordinate by coordinate."""
    bias = "bias"
    share = (1 + sum(label > 0 for _, label in rows)) / (3 + len(rows))
    z, n = {bias: -math.log(share / (1 - share)) * beta / alpha}, {}

    def weight(place):
        first, second = (0.0, 0.0) if place == bias else (l1, l2)
        value = z.get(place, 0.0)
        if abs(value) <= first:
            return 0.0
        return -(value - math.copysign(first, value)) / ((beta + math.sqrt(n.get(place, 0.0))) / alpha + second)

    for _ in range(epochs):
        for places, label in rows:
            used = [*places, bias]
            weights = {place: weight(place) for place in used}
            gradient = 1 / (1 + math.exp(-max(-35, min(35, sum(weights.values()))))) - label
            for place in used:
                before = n.get(place, 0.0)
                n[place] = before + gradient ** 2
                z[place] = z.get(place, 0.0) + gradient - (math.sqrt(n[place]) - math.sqrt(before)) / alpha * weights[place]
    return {place: weight(place) for place in z if weight(place)}


def test_weights_and_scores_against_a_plain_loop(spark, data):
    docs, labels = (spark.read.parquet(f"{data}/{name}.parquet") for name in ("documents", "labels"))
    learned = toxicity.learning_rows(docs, labels).orderBy("place", "doc_id", "text").collect()
    rows = [(toxicity.features(row.text).tolist(), int(row.label)) for row in learned]
    wanted = plain_ftrl(rows, toxicity.EPOCHS, toxicity.ALPHA, toxicity.BETA, toxicity.L1, toxicity.L2)
    found = {row.place: row.weight for row in toxicity.fit(docs, labels).collect()}
    bias = found.pop(1 << toxicity.BITS)
    assert abs(bias - wanted.pop("bias")) < 1e-9 and set(found) == set(wanted)
    assert all(abs(found[place] - wanted[place]) < 1e-9 for place in found)
    scores = {row.doc_id: row.score for row in toxicity.score_toxicity(docs, labels).collect()}
    for row in docs.limit(50).collect():
        total = bias + sum(wanted.get(place, 0.0) for place in toxicity.features(row.text).tolist())
        assert abs(scores[row.doc_id] - 1 / (1 + math.exp(-total))) < 1e-9


def test_learning_rows_are_bounded(spark, make_docs):
    docs = make_docs([(1, f"text {n % 30}", "s") for n in range(90)] + [(n, "one", "s") for n in range(2, 9)])
    labels = spark.createDataFrame([(n, 0, n % 2) for n in range(1, 9)], "doc_id long, quality int, toxic int")
    every = [tuple(row) for row in toxicity.learning_rows(docs, labels).collect()]
    assert len(every) == len(set(every)) >= 30
    some = {tuple(row) for row in toxicity.learning_rows(docs, labels, 10).collect()}
    assert len(some) == 10 and some <= set(every)


def test_weights_are_sparse_and_repeat(spark, data):
    docs, labels = (spark.read.parquet(f"{data}/{name}.parquet") for name in ("documents", "labels"))
    first, second = (sorted(map(tuple, toxicity.fit(docs, labels).collect())) for _ in range(2))
    assert first == second and len(first) < 5000


def test_features():
    assert len(toxicity.features(None)) == len(toxicity.features(" . ")) == 0
    assert len(toxicity.features("one")) == 1 and len(toxicity.features("one two three")) == 6
    assert np.array_equal(toxicity.features("A b A b A b"), toxicity.features("a B a b a b"))


def test_ftrl_learns_one_word():
    model = toxicity.Ftrl(1 << 10, l1=0.5)
    for _ in range(30):
        model.learn(np.array([3, 1]), 1)
        model.learn(np.array([5, 1]), 0)
    assert model.weights(np.array([3]))[0] > 0 > model.weights(np.array([5]))[0]
    assert model.weights(np.array([7]))[0] == 0

"""Hard negatives against all scores."""

import math

import numpy as np
import pytest
from partflow.llm import hard_negatives
from pyspark.sql import functions as F


def brute(rows, positives=5, negatives=3, least=50, most=95, every=50):
    kept = {(vec_id, label, tuple(math.floor(256 * x) for x in vector)) for vec_id, vector, label in rows
            if None not in (vec_id, label, vector) and all(x is not None and math.isfinite(x) for x in vector)}
    width = max((len(v) for _, _, v in kept), default=0)
    kept = sorted((vec_id, label, v + (0,) * (width - len(v))) for vec_id, label, v in kept)
    every_row = np.array([v for _, _, v in kept], np.int64).reshape(len(kept), width)
    out = []
    for vec_id, label, vector in kept:
        if vec_id % every:
            continue
        scores = every_row @ np.array(vector, np.int64)
        ranked = sorted((-int(score), other, own) for (other, own, _), score in zip(kept, scores, strict=True) if other != vec_id)
        for score, positive, _ in [row for row in ranked if row[2] == label][:positives]:
            fitting = [(-s, other) for s, other, own in ranked if own != label and least * -score <= 100 * -s <= most * -score][:negatives]
            out += [(vec_id, positive, rank, other, -score, s) for rank, (s, other) in enumerate(fitting, 1)]
    return sorted(out)


def relabelled(rows):
    return [(vec_id, vector, (label + 1) % 10 if vec_id % 7 == 0 else label) for vec_id, vector, label in rows]


def test_table(spark, data):
    frame = spark.read.parquet(f"{data}/embeddings.parquet")
    rows = relabelled([(row.vec_id, row.embedding, row.label) for row in frame.collect()])
    assert sorted(map(tuple, hard_negatives.mine_fiftieths(frame).collect())) == brute(rows)


@pytest.mark.parametrize("positives, negatives, least, most", [(5, 3, 50, 95), (2, 4, 0, 100), (40, 1, 90, 91)])
def test_shards_and_blocks(spark, data, positives, negatives, least, most):
    frame = spark.read.parquet(f"{data}/embeddings.parquet")
    rows = [(row.vec_id, row.embedding, row.label) for row in frame.collect()]
    found = hard_negatives.mine(frame, F.col("vec_id") % 10 == 0, positives, negatives, least, most, shard_rows=37, anchor_rows=12)
    assert sorted(map(tuple, found.collect())) == brute(rows, positives, negatives, least, most, 10)


def index_of(numbers, labels):
    order = np.argsort(labels, kind="stable")
    numbers, labels = numbers[order], labels[order]
    sides = np.argsort(-(numbers ** 2).sum(axis=0), kind="stable")
    return hard_negatives.Shard(order.astype(np.int64), labels, numbers[:, sides], sides), numbers


@pytest.mark.parametrize("weight", [0.0, 0.15, 1.0])
def test_join_finds_all_above(weight):
    """Components of falling weight, so that many are covered; thresholds of any sign."""
    chance = np.random.default_rng(7)
    numbers = np.floor(chance.normal(size=(400, 50)) * 300 * np.exp(-weight * np.arange(50))).astype(np.int64)
    shard, sorted_numbers = index_of(numbers, chance.integers(0, 3, 400))
    asked = numbers[:20]
    scores = asked @ sorted_numbers.T
    for share in (1.0, 0.9, 0.5, 0.1, 0.0, -0.5, -np.inf):
        least = share * scores.max(axis=1).astype(float)
        query, row, score = shard.above(asked[:, shard.sides], hard_negatives.suffix_norms(asked[:, shard.sides]), least, 0, 400)
        wanted = np.argwhere(scores >= least[:, None])
        assert sorted(zip(query, row)) == sorted(map(tuple, wanted)) and np.array_equal(score, scores[query, row])


def test_windows_over_shards():
    chance = np.random.default_rng(8)
    for size in (1, 5, 300):
        numbers, labels = chance.integers(-3, 4, (size, 6)), chance.integers(0, 4, size)
        parts = [index_of(numbers[at::3], labels[at::3])[0] for at in range(3) if len(numbers[at::3])]
        for at, part in enumerate(parts):
            part.ids = part.ids * 3 + at
        block = hard_negatives.Block(np.arange(min(size, 9)), labels[:9], numbers[:9])
        for others in (False, True):
            low = chance.integers(-20, 10, (len(block.ids), 2))
            windows = hard_negatives.Windows(low, low + chance.integers(-3, 20, low.shape), 4)
            for part in parts:
                hard_negatives.join(part, block, windows, others)
            scores = block.numbers @ numbers.T
            for query in range(len(block.ids)):
                for slot in range(2):
                    fitting = [(-s, n) for n, s in enumerate(scores[query]) if n != query and (labels[n] != labels[query]) == others
                               and low[query, slot] <= s <= windows.high[query, slot]]
                    wanted = sorted(fitting)[:4]
                    kept = windows.scores[query, slot] > hard_negatives.NONE
                    assert [(-s, i) for s, i in zip(windows.scores[query, slot][kept], windows.ids[query, slot][kept])] == wanted


def test_odd_rows(spark):
    chance = np.random.default_rng(3)
    rows = [(n, chance.normal(size=6).tolist(), n % 4) for n in range(300)]
    rows += [(50, None, 1), (100, [0.1] * 6, None), (150, [float("nan")] * 6, 1), (200, [None] * 6, 1), (None, [1.0] * 6, 2),
             (250, [], 1), (300, [1.0, 2.0], 3), (350, [0.0] * 6, 0), (400, [-0.5] * 6, 77), (50, [0.5] * 6, 2), (50, [0.5] * 6, 3)]
    rows += rows[:60] + [(n, [0.5, 0.25, 0.0, 1.0, 0.0, 0.0], n % 2) for n in range(2000, 2400)]
    frame = spark.createDataFrame([(vec_id, vector, label, "x", 1) for vec_id, vector, label in rows],
                                  "vec_id long, embedding array<double>, label int, numbers string, block int")
    found = hard_negatives.mine(frame, F.col("vec_id") % 50 == 0, shard_rows=100, anchor_rows=5)
    assert sorted(map(tuple, found.collect())) == brute(rows)
    few = frame.where("vec_id IN (50, 51, 54)")
    assert sorted(map(tuple, hard_negatives.mine(few, F.col("vec_id") % 50 == 0).collect())) == brute(
        [row for row in rows if row[0] in (50, 51, 54)])
    empty = hard_negatives.mine_fiftieths(frame.where("false"))
    assert empty.count() == 0
    assert empty.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]

"""Neighbours against all similarities."""

import math

import numpy as np
from partflow.llm import neighbours


def brute(rows, k=5):
    usable = {(vec_id, tuple(vector)) for vec_id, vector in rows if vec_id is not None and vector and all(
        x is not None and math.isfinite(x) for x in vector) and any(vector)}
    out = {}
    for query, vector in usable:
        if query % 50:
            continue
        scored = []
        for vec_id, other in usable:
            if vec_id != query and len(other) == len(vector):
                a, b = np.array(vector), np.array(other)
                scored.append((-float(a @ b) / float(np.linalg.norm(a) * np.linalg.norm(b)), vec_id))
        out[query] = [(vec_id, -score) for score, vec_id in sorted(scored)[:k]]
    return out


def check(found, wanted):
    got = {}
    for row in found:
        got.setdefault(row.query_id, {})[row.rank] = (row.vec_id, row.score)
    assert set(got) == {query for query, best in wanted.items() if best}
    for query, best in wanted.items():
        assert sorted(got.get(query, {})) == list(range(1, len(best) + 1))
        for place, (vec_id, score) in enumerate(best, 1):
            assert got[query][place][0] == vec_id
            assert abs(got[query][place][1] - score) < 1e-12


def test_documents_over_shards_and_blocks(spark, data):
    rows = spark.read.parquet(f"{data}/embeddings.parquet")
    wanted = brute([(row.vec_id, row.embedding) for row in rows.collect()])
    check(neighbours.search_fiftieths(rows).collect(), wanted)
    check(neighbours.nearest(rows, rows.where("vec_id % 50 = 0"), 5, shard_rows=40, query_rows=2).collect(), wanted)


def test_scaled_copies_over_leaves():
    for seed in range(30):
        chance = np.random.default_rng(seed)
        # Whole numbers, so that sums are exact in any order.
        vectors = (chance.integers(1, 50, 24) * chance.integers(1, 1000, 200)[:, None]).astype(float)
        ids = chance.permutation(200).astype(np.int64)
        trees = [neighbours.VantageTree(vectors, ids, leaf) for leaf in (8, 200)]
        (scores, found), (all_scores, all_found) = (tree.search(vectors[:40], ids[:40], 5) for tree in trees)
        assert np.array_equal(found, all_found) and np.array_equal(scores, all_scores)


def test_odd_rows(spark):
    chance = np.random.default_rng(3)
    rows = [(n, chance.normal(size=4).tolist()) for n in range(300)]
    rows += [(50, None), (1000, [0.0] * 4), (1050, [1.0, None, 0.0, 0.0]), (1100, [float("nan"), 1.0, 0.0, 0.0]), (1150, []),
             (1200, [float("inf"), 0.0, 0.0, 0.0]), (None, [1.0] * 4), (1250, [1.0, 2.0]), (1251, [1.0, 2.5])]
    rows += [rows[100], rows[101]]
    same = [0.5, 0.25, 0.0, 1.0]
    rows += [(n, same) for n in range(2000, 2400)]
    frame = spark.createDataFrame([(vec_id, vector, 1, "x") for vec_id, vector in rows],
                                  "vec_id long, embedding array<double>, label int, rank string")
    wanted = brute(rows)
    # Equal vectors tie exactly: the smaller ids win.
    assert [vec_id for vec_id, _ in wanted[2000]] == [2001, 2002, 2003, 2004, 2005]
    check(neighbours.search_fiftieths(frame).collect(), wanted)
    assert neighbours.search_fiftieths(frame.where("false")).count() == 0


def test_factor_trades_recall(spark, data):
    rows = spark.read.parquet(f"{data}/embeddings.parquet")
    wanted = brute([(row.vec_id, row.embedding) for row in rows.collect()])
    found = neighbours.nearest(rows, rows.where("vec_id % 50 = 0"), 5, factor=1.2).collect()
    hits = sum((row.vec_id in {vec_id for vec_id, _ in wanted[row.query_id]}) for row in found)
    assert hits >= 0.9 * sum(map(len, wanted.values()))

"""Vector codes against rounds over all pairs of pieces and entries."""

import hashlib
import math

import numpy as np
import pytest
from partflow.llm import vector_codes


def brute(rows, parts=16, entries=64, rounds=2):
    """(vec_id, label, code, error) of the usable rows, and the codebooks."""
    kept = [(vec_id, label, [math.floor(256 * x) for x in vector]) for vec_id, label, vector in rows
            if vector is not None and all(x is not None and math.isfinite(x) for x in vector)]
    width = max(1, -(-max((len(v) for _, _, v in kept), default=0) // parts)) * parts
    kept = [(vec_id, label, v + [0] * (width - len(v))) for vec_id, label, v in kept]
    kept.sort(key=lambda row: (row[0] is None, row[0] or 0, row[2]))
    pieces = np.array([v for _, _, v in kept], np.int64).reshape(len(kept), parts, width // parts)
    books = [[piece.tolist() for piece in pieces[:entries, part]] for part in range(parts)]

    def nearest(part):
        away = ((pieces[:, part, None, :] - np.array(books[part])[None]) ** 2).sum(axis=2)
        return away.argmin(axis=1), away.min(axis=1)

    for _ in range(rounds):
        for part in range(parts):
            chosen, _ = nearest(part)
            for entry in set(chosen):
                members = pieces[chosen == entry, part]
                books[part][entry] = [int(total) // len(members) for total in members.sum(axis=0)]
    both = [nearest(part) for part in range(parts)] if kept else []
    codes = ["".join(f"{chosen[n]:02x}" for chosen, _ in both) for n in range(len(kept))]
    errors = [int(sum(away[n] for _, away in both)) for n in range(len(kept))]
    return [(vec_id, label, code, error) for (vec_id, label, _), code, error in zip(kept, codes, errors, strict=True)], books


def check(found, rows, books):
    labels = {}
    for _, label, _, error in rows:
        labels[label] = labels.get(label, 0) + error
    digest = hashlib.sha256(",".join(str(x) for book in books for piece in book for x in piece).encode()).hexdigest()
    assert sorted((str(row.vec_id), row.code, row.error, row.label_error, row.codebooks_sha256) for row in found) == sorted(
        (str(vec_id), code, error, labels[label], digest) for vec_id, label, code, error in rows)


def test_table(spark, data):
    frame = spark.read.parquet(f"{data}/embeddings.parquet")
    rows = [(row.vec_id, row.label, row.embedding) for row in frame.collect()]
    check(vector_codes.digest_codes(frame.repartition(3)).collect(), *brute(rows))


@pytest.mark.parametrize("parts, entries, rounds, shard_rows", [(4, 7, 3, 50), (8, 256, 1, 1000), (1, 1, 2, 33)])
def test_parameters(spark, data, parts, entries, rounds, shard_rows):
    frame = spark.read.parquet(f"{data}/embeddings.parquet")
    rows = [(row.vec_id, row.label, row.embedding) for row in frame.collect()]
    wanted, books = brute(rows, parts, entries, rounds)
    found, found_books = vector_codes.encode_vectors(frame, parts, entries, rounds, shard_rows)
    assert found_books.tolist() == books
    assert sorted(map(tuple, found.collect())) == sorted(wanted)


def test_trees_assign_whole_nodes():
    chance = np.random.default_rng(4)
    centres = chance.integers(-1000, 1000, (2, 8, 4))
    points = np.stack([centre[chance.integers(0, 8, 3000)] + chance.integers(-3, 4, (3000, 4)) for centre in centres])
    ordered, order = vector_codes.plant(points, 16)
    assert np.array_equal(np.take_along_axis(points, order[..., None], 1), ordered)
    forest = vector_codes.Forest(ordered, 16)
    found = vector_codes.meet(forest, centres)
    whole = (forest.shape.high - forest.shape.low)[found.node].sum()
    assert whole > 0.9 * 6000 and whole + len(found.point) == 6000
    codes, away = vector_codes.codes_of(forest, centres)
    every = ((ordered[:, :, None] - centres[:, None]) ** 2).sum(axis=3)
    assert np.array_equal(codes, every.argmin(axis=2)) and np.array_equal(away, every.min(axis=2))


def test_ties_go_to_the_lower_entry():
    chance = np.random.default_rng(5)
    for size in (1, 2, 15, 16, 17, 500):
        points, books = chance.integers(-2, 3, (3, size, 2)), chance.integers(-2, 3, (3, 13, 2))
        ordered, _ = vector_codes.plant(points, 16)
        codes, _ = vector_codes.codes_of(vector_codes.Forest(ordered, 16), books)
        assert np.array_equal(codes, ((ordered[:, :, None] - books[:, None]) ** 2).sum(axis=3).argmin(axis=2))


def test_odd_rows(spark):
    chance = np.random.default_rng(3)
    rows = [(n, n % 3 if n % 5 else None, chance.normal(size=40).tolist()) for n in range(200)]
    rows += [(7, None, None), (8, 1, [float("nan")] * 40), (9, 1, [None] * 40), (10, 1, [float("inf")] * 40), (None, 2, [0.5] * 40),
             (11, 1, []), (12, None, [1.0, 2.0]), (-5, 1, [-0.001] * 40), (-5, 1, [0.25] * 40)]
    rows += rows[:20] + [(1000 + n, 9, [0.1] * 40) for n in range(300)]
    frame = spark.createDataFrame([(vec_id, vector, label, "x", "y") for vec_id, label, vector in rows],
                                  "vec_id long, embedding array<double>, label int, code string, numbers string")
    check(vector_codes.digest_codes(frame).collect(), *brute(rows))
    few = frame.where("vec_id < 5")
    check(vector_codes.digest_codes(few).collect(), *brute([row for row in rows if row[0] is not None and row[0] < 5]))
    empty = vector_codes.digest_codes(frame.where("false"))
    assert empty.count() == 0 and empty.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    cut = spark.createDataFrame([(1, [1e300, -1e300], 1)], "vec_id long, embedding array<double>, label int")
    assert vector_codes.encode_vectors(cut)[1].reshape(-1).tolist()[:2] == [vector_codes.LIMIT, -vector_codes.LIMIT]

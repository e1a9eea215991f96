"""Mixing against a heap that hands out one block at a time."""

import heapq
import re
from collections import Counter

from partflow.llm import mixing
from pyspark.sql import functions as F


def level_targets(sizes, weights=(3, 1, 2), budget=1.5, repeats=2):
    """Shared out again and again until no source is above its limit."""
    order = sorted(sizes, key=lambda source: (source is None, (source or "").encode()))
    weight = {source: weights[place % len(weights)] for place, source in enumerate(order)}
    target, rest, is_open = {}, budget * sum(sizes.values()), set(order)
    while is_open:
        unit = rest / sum(weight[source] for source in is_open)
        full = {source for source in is_open if unit * weight[source] > repeats * sizes[source]}
        if not full:
            return target | {source: unit * weight[source] for source in is_open}
        for source in full:
            target[source] = repeats * sizes[source]
            rest -= target[source]
        is_open -= full
    return target


def highest_quotients(votes, limits, seats):
    heap = [(-votes[key], key, 0) for key in votes if limits[key] and votes[key] > 0]
    heapq.heapify(heap)
    given = Counter()
    while seats and heap:
        _, key, k = heapq.heappop(heap)
        given[key] += 1
        seats -= 1
        if k + 1 < limits[key]:
            heapq.heappush(heap, (-votes[key] / (2 * k + 3), key, k + 1))
    return given


def check(docs, rows):
    plan = [row.asDict() for row in mixing.plan_mix(docs).collect()]
    assert len(plan) == len(rows)
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    targets = level_targets(dict(sizes))
    taken = Counter()
    for row in plan:
        assert row["source_size"] == sizes[row["source"]]
        assert abs(row["target"] - targets[row["source"]]) < 1e-6 * max(1, row["target"])
        assert 0 <= row["taken"] <= 2 * row["size"]
        assert row["taken"] == sum((p["end"] - p["start"]) * p["times"] for p in row["pieces"])
        taken[row["source"]] += row["taken"]
    for source, target in targets.items():
        assert abs(taken[source] - target) <= max(2, 0.02 * target)
    return plan


def test_odd_rows(odd_docs, odd_rows):
    first = check(odd_docs, odd_rows)
    again = [row.asDict() for row in mixing.plan_mix(odd_docs.repartition(3)).collect()]
    digest = lambda plan: sorted((str(r["doc_id"]), str(r["source"]), r["size"], r["taken"]) for r in plan)
    assert digest(first) == digest(again)


def test_hot_source(make_docs):
    rows = [(n, "w " * (n % 50), "hot" if n % 3 else f"s{n % 7}") for n in range(900)]
    check(make_docs(rows), rows)


def test_documents(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    check(docs, [tuple(row) for row in docs.select("doc_id", "text", "source").collect()])


def test_empty_and_wordless(make_docs):
    assert mixing.plan_mix(make_docs([(1, "a", "s")]).where("false")).count() == 0
    plan = mixing.plan_mix(make_docs([(1, "", "s"), (2, None, None)])).collect()
    assert [(row.size, row.target, row.taken) for row in plan] == [(0, 0.0, 0)] * 2


def test_apportion_is_sainte_lague(spark):
    cases = [([5, 3, 1], 9, [9, 9, 9]), ([1000, 1, 1, 1, 1], 50, [99] * 5), ([7, 7, 7], 4, [1, 9, 9]), ([53, 24, 23], 7, [9] * 3),
             ([98000, 490, 490, 490, 490], 200, [999] * 5), ([0, 4], 3, [5, 5])]
    rows = [(group, key, float(vote), seats, limit) for group, (votes, seats, limits) in enumerate(cases)
            for key, (vote, limit) in enumerate(zip(votes, limits, strict=True))]
    found = mixing.apportion(spark.createDataFrame(rows, "g int, key int, votes double, seats long, cap long"),
                             ["g"], "key", "votes", "seats", "cap")
    quotas = {(row.g, row.key): row.quota for row in found.collect()}
    for group, (votes, seats, limits) in enumerate(cases):
        wanted = highest_quotients(dict(enumerate(votes)), dict(enumerate(limits)), seats)
        assert [quotas[group, key] for key in range(len(votes))] == [wanted[key] for key in range(len(votes))]


def test_cut_pieces(spark):
    rows = spark.createDataFrame([("a b  c d", [(1, 3, 2)])], "text string, pieces array<struct<start:long,end:long,times:long>>")
    cut = rows.select(mixing.cut_pieces(F.col("text"), F.col("pieces")).alias("cut")).first()["cut"]
    assert [tuple(piece) for piece in cut] == [("b c", 2)]

"""Fingerprints bit by bit, components by comparing all pairs."""

import random

import xxhash
from partflow.llm import simhash


def fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[n:n + 3]) for n in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(shingle, 42) for shingle in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(value >> bit & 1 for value in hashes) > len(hashes))


def roots(rows):
    """Fingerprint to the root of its component."""
    values = sorted({value for _, value in rows})
    parent = {value: value for value in values}

    def find(value):
        while parent[value] != value:
            value = parent[value]
        return value

    for place, a in enumerate(values):
        for b in values[:place]:
            if (a ^ b).bit_count() <= 2:
                parent[find(a)] = find(b)
    return {value: find(value) for value in values}


def brute(rows):
    root, lowest = roots(rows), {}
    for doc_id, value in rows:
        if doc_id is not None:
            lowest[root[value]] = min(doc_id, lowest.get(root[value], doc_id))
    return sorted(((doc_id, f"{value:016x}", lowest.get(root[value])) for doc_id, value in rows), key=str)


def test_odd_rows(odd_docs, odd_rows):
    wanted = brute([(doc_id, fingerprint(text)) for doc_id, text, _ in odd_rows])
    assert sorted(map(tuple, simhash.near_duplicates(odd_docs).collect()), key=str) == wanted


def test_documents(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    wanted = brute([(row.doc_id, fingerprint(row.text)) for row in docs.collect()])
    assert sorted(map(tuple, simhash.near_duplicates(docs).collect()), key=str) == wanted


def test_trie_finds_every_link(spark):
    chance = random.Random(4)
    values = [chance.getrandbits(64) for _ in range(40)]
    for value in values[:30]:
        for _ in range(4):
            values.append(value ^ sum({1 << chance.randrange(64) for _ in range(chance.randint(1, 4))}))
    values = sorted({value - (1 << 64) if value >> 63 else value for value in [*values, 0, 1, 3, (1 << 64) - 1]})
    frame = spark.createDataFrame([(value,) for value in values], "fingerprint long")
    found = {tuple(row) for row in simhash.linked_values(frame).collect()}
    mask = (1 << 64) - 1
    assert found == {(a, b) for a in values for b in values if a < b and ((a ^ b) & mask).bit_count() <= 2}


def test_dense_cluster(spark):
    values = [sum(1 << bit for bit in range(10) if number >> bit & 1) for number in range(1024)]
    frame = spark.createDataFrame([(value,) for value in values], "fingerprint long")
    assert simhash.linked_values(frame).count() == 1024 * (10 + 45) // 2


def test_keep_one(odd_docs, odd_rows):
    rows = [(doc_id, fingerprint(text)) for doc_id, text, _ in odd_rows]
    root, groups = roots(rows), {}
    for doc_id, value in rows:
        groups.setdefault(root[value], set()).add(doc_id)
    kept = simhash.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = [row.doc_id for row in kept.collect()]
    assert sorted(map(str, ids)) == sorted(str(min(group, key=lambda n: (n is None, n or 0))) for group in groups.values())


def test_empty_table(odd_docs):
    assert simhash.near_duplicates(odd_docs.where("false")).count() == 0
    assert simhash.keep_one(odd_docs.where("false")).count() == 0

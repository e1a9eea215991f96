"""Decontamination against windows kept in a dict."""

import hashlib
import re

from llm_texts import prose
from partflow.llm import decontamination
from pyspark.sql import functions as F

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORDS.findall((text or "").translate(LOWER))


def brute(docs, items, window=13):
    known = {}
    for item, text in items:
        own = words(text)
        length = min(window, len(own))
        for at in range(len(own) - length + 1 if own else 0):
            known.setdefault(tuple(own[at:at + length]), set()).add(item)
    out = []
    for doc_id, text in docs:
        own, hit, found = words(text), set(), set()
        for length in {len(key) for key in known}:
            for at in range(len(own) - length + 1):
                if tuple(own[at:at + length]) in known:
                    hit |= set(range(at, at + length))
                    found |= known[tuple(own[at:at + length])]
        ids = sorted(str(item) for item in found if item is not None)
        out.append((doc_id, len(own), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(),
                    bool(hit) and 20 * len(hit) >= len(own)))
    return sorted(out, key=str)


def found(docs, items):
    rows = decontamination.find_contamination(docs, items).select(
        "doc_id", "n_words", "n_hit", "n_items", decontamination.item_digest(F.col("item_ids")), "contaminated")
    return sorted(map(tuple, rows.collect()), key=str)


def cases(odd_rows):
    passage = prose(20, 40)
    docs = [(doc_id, text) for doc_id, text, _ in odd_rows] + [
        (50, prose(21, 30) + " " + passage.upper() + " " + prose(22, 5)), (51, prose(23, 900) + " " + passage),
        (52, " ".join(passage.split()[:12])), (53, "tiny item here"), (54, passage), (54, passage), (55, passage + " " + passage)]
    items = [(1, passage), (1, passage), (2, "Tiny, item!"), (3, None), (4, ""), (None, prose(3, 40)), (5, " ".join(passage.split()[5:30])),
             (10, prose(2, 70)), (6, "...")]
    return docs, items


def test_odd_rows(spark, make_docs, odd_rows):
    docs, items = cases(odd_rows)
    frame = make_docs([(doc_id, text, "s") for doc_id, text in docs])
    benchmark = spark.createDataFrame([(*item, 1, "x") for item in items], "item_id long, text string, length int, hits string")
    wanted = brute(docs, items)
    assert found(frame, benchmark) == wanted
    kept = decontamination.decontaminate(frame, benchmark)
    assert kept.columns == frame.columns
    assert kept.count() == sum(not row[5] for row in wanted)


def test_documents(spark, data):
    docs, items = (spark.read.parquet(f"{data}/{name}.parquet") for name in ("documents", "benchmark"))
    assert found(docs, items) == brute([tuple(row) for row in docs.select("doc_id", "text").collect()], [tuple(row) for row in items.collect()])


def test_large_benchmark_joins_by_shuffle(spark, make_docs, odd_rows, monkeypatch):
    docs, items = cases(odd_rows)
    frame = make_docs([(doc_id, text, "s") for doc_id, text in docs])
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(decontamination, "BROADCAST_WINDOWS", 0)
    assert found(frame, benchmark) == brute(docs, items)


def test_empty_tables(spark, odd_docs):
    nothing = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.decontaminate(odd_docs, nothing).count() == odd_docs.count()
    assert decontamination.find_contamination(odd_docs.where("false"), nothing).count() == 0


def test_spans_removed(spark, make_docs):
    frame = make_docs([(1, "Keep this. one two three! and that.", "s"), (2, "clean", "s"), (3, None, "s")])
    items = spark.createDataFrame([(1, "One, two three")], "item_id long, text string")
    texts = {row.doc_id: row.text for row in decontamination.decontaminate(frame, items, "spans").collect()}
    assert texts == {1: "Keep this! and that.", 2: "clean", 3: None}

"""SimHash near-duplicates by a binary trie self-join.

Fingerprints are made in Arrow batches, one number per document. Their distinct values stand in binary
tries and a trie is joined with itself by traversing pairs of nodes together, level by level: a pair of
nodes goes on to the pairs of their children, adding the bits in which these differ, and is dropped when
they are more than the budget. With a budget of two, the three thirds of the bits cannot all differ, so
there is one trie for each third, which stands on top and must be equal: the traversal starts at nodes
that hold at least two values instead of at the root, and no list of pairs grows beyond real neighbours.
A level is a join of node pairs with children, both bounded per key, so no group meets in one task, and
equal fingerprints (copies) are one value however many documents have them.

Defined results: NULL and empty texts have fingerprint zero, linked like any other; texts of fewer than
three words are one shingle; rows that repeat a doc_id are rows of their own in ``fingerprints`` and
``near_duplicates``; a NULL doc_id is never the component's id unless all its documents have none; an
empty table gives no rows. ``keep_one`` keeps of each component the row of the smallest doc_id (NULL
last), of several texts under it the one with the smallest hash, and of rows that repeat both, one; all
columns of ``docs`` are kept, clashing names do no harm.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from partflow.llm.common import text_tag, unused
from partflow.llm.graph import components
from partflow.session import settle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh64_intdigest

SHINGLE, SEED, BUDGET = 3, 42, 2


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """SimHash of the word shingles of a text in UTF-8, as a signed 64-bit number."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    width = min(shingle, len(words))
    starts = np.concatenate(([0], ends[: len(words) - width] + 1))
    parts = [line[a:b] for a, b in zip(starts.tolist(), ends[width - 1:].tolist(), strict=True)]
    hashes = np.fromiter(map(xxh64_intdigest, parts, repeat(SEED)), np.uint64, len(parts))
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    often = 2 * np.add.reduce(bits, axis=0, dtype=np.int64) > len(parts)
    return int(np.packbits(often, bitorder="little").view(np.int64)[0])


def fingerprint_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The last column, a text, becomes its fingerprint; the others stay."""
    for batch in batches:
        texts = batch.columns[-1].cast(pa.binary() if pa.types.is_string(batch.columns[-1].type) else pa.large_binary())
        marks = pa.array([fingerprint(text) for text in texts.to_pylist()], pa.int64())
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], marks], [*batch.schema.names[:-1], "fingerprint"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, tag (hash of the text) and fingerprint of every row."""
    rows = docs.select("doc_id", text_tag(F.col("text")).alias("tag"), "text")
    schema = T.StructType([*rows.schema.fields[:-1], T.StructField("fingerprint", T.LongType())])
    return rows.mapInArrow(fingerprint_batches, schema)


def rotated(value: Column, bits: int) -> Column:
    if not bits:
        return value
    return F.shiftleft(value, bits).bitwiseOR(F.shiftrightunsigned(value, 64 - bits))


def linked_values(values: DataFrame, budget: int = BUDGET) -> DataFrame:
    """Pairs (a, b) of distinct values of the column fingerprint that differ in at most ``budget`` bits."""
    top = 64 // (budget + 1)
    turns = [64 * nth // (budget + 1) for nth in range(budget + 1)]
    tries = values.select(F.explode(F.array(*[F.struct(
        F.lit(nth).alias("trie"), rotated(F.col("fingerprint"), turn).alias("value")) for nth, turn in enumerate(turns)]
    )).alias("t")).select("t.*")
    step = -(-(64 - top) // 5)
    depths = [*range(top, 64, step), 64]

    def node(depth: int) -> Column:
        return F.shiftrightunsigned("value", 64 - depth)

    tops = tries.groupBy("trie", node(top).alias("parent")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    # Few values share a top node with another one.
    shared = settle(tries.withColumn("parent", node(top)).join(tops, ["trie", "parent"], "left_semi").select("trie", "value"))
    pairs = tops.select("trie", F.col("parent").alias("a"), F.col("parent").alias("b"), F.lit(0).alias("diff"))
    for depth, deeper in zip(depths, depths[1:], strict=False):
        children = shared.groupBy("trie", node(depth).alias("parent"), node(deeper).alias("child")).agg(
            F.count(F.lit(1)).alias("n"))
        left = children.select("trie", F.col("parent").alias("a"), F.col("child").alias("x"), F.col("n").alias("leaves"))
        right = children.select("trie", F.col("parent").alias("b"), F.col("child").alias("y"))
        new_bits = F.col("x").bitwiseXOR(F.col("y")).bitwiseAND(F.lit((1 << (deeper - depth)) - 1))
        pairs = (pairs.join(left, ["trie", "a"]).join(right, ["trie", "b"])
                 .withColumn("diff", F.col("diff") + F.bit_count(new_bits).cast("int"))
                 .where(F.col("diff") <= budget)
                 # A node meets itself while it holds two values, and each pair below it is met once.
                 .where(F.when(F.col("a") != F.col("b"), F.lit(True)).when(F.col("x") == F.col("y"), F.col("leaves") > 1)
                        .otherwise(F.col("x") < F.col("y")))
                 .select("trie", F.col("x").alias("a"), F.col("y").alias("b"), "diff"))
    back = [(F.col("trie") == nth, 64 - turn) for nth, turn in enumerate(turns)]

    def value(name: str) -> Column:
        found = F.col(name)
        for condition, bits in back[1:]:
            found = F.when(condition, rotated(F.col(name), bits)).otherwise(found)
        return found

    pairs = pairs.select(value("a").alias("a"), value("b").alias("b"))
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def value_components(marks: DataFrame, budget: int = BUDGET) -> DataFrame:
    """fingerprint, root (the component's smallest fingerprint) and first_doc of every distinct fingerprint."""
    values = settle(marks.groupBy("fingerprint").agg(F.min("doc_id").alias("first_doc")))
    groups = components(linked_values(values.select("fingerprint"), budget), "a", "b")
    return values.join(groups, F.col("fingerprint") == F.col("node"), "left").select(
        "fingerprint", F.coalesce("component", "fingerprint").alias("root"), "first_doc")


def near_duplicates(docs: DataFrame, budget: int = BUDGET) -> DataFrame:
    """doc_id, fingerprint (hexadecimal) and component_id (smallest doc_id reachable) of every row."""
    marks = settle(fingerprints(docs))
    rooted = settle(value_components(marks, budget))
    lowest = rooted.groupBy("root").agg(F.min("first_doc").alias("component_id"))
    named = rooted.join(lowest, "root").select("fingerprint", "component_id")
    return marks.join(named, "fingerprint").select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def document_key(doc_id: Column, tag: Column) -> Column:
    return F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("")), tag.cast("string"))


def keep_one(docs: DataFrame, budget: int = BUDGET) -> DataFrame:
    """``docs`` with one document of each group of near-duplicates."""
    marks = settle(fingerprints(docs))
    rooted = value_components(marks, budget).select("fingerprint", "root")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tag")).alias("first")
    # Within a fingerprint first: copies combine before they meet their component.
    heads = marks.groupBy("fingerprint").agg(first).join(rooted, "fingerprint").groupBy("root").agg(F.min("first").alias("first"))
    key, = unused(docs, "key")
    chosen = heads.select(document_key(F.col("first.doc_id"), F.col("first.tag")).alias(key))
    keyed = docs.withColumn(key, document_key(F.col("doc_id"), text_tag(F.col("text"))))
    return keyed.join(chosen, key, "left_semi").dropDuplicates([key]).drop(key)

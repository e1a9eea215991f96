"""Toxicity by FTRL-proximal logistic regression over hashed words, word pairs and skip-grams.

Learning takes a bounded sample of labelled texts (of at most MAX_LABELS labelled doc_ids the distinct texts of
smallest seeded hash, at most MAX_LABELS again), goes through it EPOCHS times in one task, and leaves a sparse table of weights: every coordinate has a rate
of its own, and L1 keeps most of them at zero. The bias is outside L1 and starts from the share of label 1, smoothed to
(1 + ones) / (3 + rows): below one half without labels. Scoring broadcasts the weights (at most 2 ** BITS of them)
and reads every whole text once, in Arrow batches, without a shuffle.

Defined results: NULL counts as empty; an empty text scores as the bias alone; labels without doc_id or
toxic are not learned from; of several labels of a doc_id the larger counts, and of several texts under a
labelled doc_id each is learned from once, as far as the sample goes; a score of one half or more is predicted toxic, so
with no labels every score is 1/3 and nothing is, and where most labels are 1 a text without a learned word may be; rows that
repeat a doc_id are scored each; ``keep_clean`` keeps all columns of ``docs`` and drops what is predicted toxic.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from partflow.llm.common import text_tag, unused
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Weights: a table of 2 ** 20 doubles, 8 MB on each executor.
BITS = 20
#: Labelled doc_ids and distinct texts learned from. The features of the texts are held in one task.
MAX_LABELS, EPOCHS = 20_000, 3
ALPHA, BETA, L1, L2 = 2.0, 1.0, 5.0, 1.0
SEED, FOLDS = "toxic-1", 5
WORD = re.compile(r"\w+")
# Odd 64-bit multipliers that spread the hashes of words over the table.
SPREAD = tuple(np.uint64(n) for n in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93))


def features(text: str | None, bits: int = BITS) -> np.ndarray:
    """Distinct places of a text's words, word pairs and skip-grams (one word left out)."""
    words = WORD.findall((text or "").lower())
    if not words:
        return np.empty(0, np.int32)
    hashes = np.fromiter((crc32(word.encode()) for word in words), np.uint64, len(words)) + np.uint64(1)
    first = hashes * SPREAD[0]
    pairs = (first[:-1] ^ (hashes[1:] * SPREAD[1])) * SPREAD[3]
    skips = (first[:-2] ^ (hashes[2:] * SPREAD[2])) * SPREAD[3]
    return np.unique(np.concatenate((first, pairs, skips)) >> np.uint64(64 - bits)).astype(np.int32)


class Ftrl:
    """FTRL-proximal: per-coordinate rates, weights kept at zero until their gradients outgrow L1.

    With ``share``, the last weight is a bias: it starts from that share of label 1, without L1 and L2.
    """

    def __init__(self, size: int, alpha: float = ALPHA, beta: float = BETA, l1: float = L1, l2: float = L2,
                 share: float | None = None) -> None:
        self.z, self.n = np.zeros(size), np.zeros(size)
        self.l1, self.l2 = np.full(size, l1), np.full(size, l2)
        self.alpha, self.beta = alpha, beta
        if share is not None:
            self.l1[-1] = self.l2[-1] = 0.0
            self.z[-1] = -np.log(share / (1 - share)) * beta / alpha

    def weights(self, at: np.ndarray | slice) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - self.l1[at], 0.0)
        return -shrunk / ((self.beta + np.sqrt(n)) / self.alpha + self.l2[at])

    def learn(self, at: np.ndarray, label: int) -> None:
        weights = self.weights(at)
        gradient = 1 / (1 + np.exp(-np.clip(weights.sum(), -35, 35))) - label
        n = self.n[at]
        grown = n + gradient * gradient
        self.z[at] += gradient - (np.sqrt(grown) - np.sqrt(n)) / self.alpha * weights
        self.n[at] = grown


def held_out(doc_id: Column, folds: int = FOLDS) -> Column:
    """Whether a doc_id stays out of learning; NULL does."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(True))


def learning_rows(docs: DataFrame, labels: DataFrame, limit: int = MAX_LABELS) -> DataFrame:
    """Distinct texts and labels, at most ``limit``, of at most ``limit`` labelled doc_ids outside the held-out fold."""
    known = (labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max("toxic").alias("label")))
    order = F.xxhash64(F.concat(F.lit(SEED), F.col("doc_id").cast("string")))
    sample = known.withColumn("place", order).orderBy("place", "doc_id").limit(limit)
    tagged = docs.select("doc_id", text_tag(F.col("text")).alias("tag"), "text")
    # At most ``limit`` small rows: bounded, whatever the size of the tables.
    texts = tagged.select("doc_id", "tag").join(F.broadcast(sample), "doc_id").distinct()
    seeded = F.xxhash64(F.lit(SEED), "doc_id", "tag")
    chosen = texts.withColumn("seeded", seeded).orderBy("seeded", "doc_id", "tag").limit(limit).drop("seeded")
    return tagged.join(F.broadcast(chosen), ["doc_id", "tag"]).dropDuplicates(["doc_id", "tag"]).select(
        "place", "doc_id", "text", "label")


def fit(docs: DataFrame, labels: DataFrame, limit: int = MAX_LABELS, epochs: int = EPOCHS, bits: int = BITS) -> DataFrame:
    """place and weight of every weight that is not zero, and of the bias (place 2 ** bits); no row without labels."""
    size = 1 << bits

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [(np.append(features(text, bits), np.int32(size)), int(label)) for batch in batches
                for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
        model = Ftrl(size + 1, share=(1 + sum(label > 0 for _, label in rows)) / (3 + len(rows)))
        for _ in range(epochs):
            for at, label in rows:
                model.learn(at, label)
        weights = model.weights(slice(None))
        kept = np.append(np.flatnonzero(weights[:-1]), size)
        yield pa.RecordBatch.from_arrays([pa.array(kept, pa.int64()), pa.array(weights[kept])], ["place", "weight"])

    rows = learning_rows(docs, labels, limit).repartition(1).sortWithinPartitions("place", "doc_id", "text")
    return rows.select("text", "label").mapInArrow(learn, "place long, weight double")


def score(docs: DataFrame, weights: DataFrame, name: str = "score", bits: int = BITS) -> DataFrame:
    """``docs`` and a column of that name: how likely label 1 is, from 0 to 1."""
    table = np.zeros((1 << bits) + 1)
    # Without labels the share of label 1 is smoothed to 1 / 3.
    table[-1] = -np.log(2)
    # Bounded by the size of the table, and far smaller by L1.
    for row in weights.collect():
        table[row["place"]] = row["weight"]
    shared = docs.sparkSession.sparkContext.broadcast(table)
    place = docs.columns.index("text")
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            sums = np.array([known[features(text, bits)].sum() for text in batch.column(place).to_pylist()]) + known[-1]
            scores = 1 / (1 + np.exp(-np.clip(sums, -35, 35)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], schema.names)

    return docs.mapInArrow(scan, schema)


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, score and predicted (1 from a score of one half)."""
    scored = score(docs.select("doc_id", "text"), fit(docs, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows predicted toxic."""
    name, = unused(docs, "score")
    return score(docs, fit(docs, labels), name).where(F.col(name) < 0.5).drop(name)

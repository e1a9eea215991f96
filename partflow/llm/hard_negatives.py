"""Hard negatives by threshold joins over an inverted index that leaves out what suffix norms cover.

Scores are inner products of whole numbers, floor(256 * x). Rows are dealt to shards of at most SHARD_ROWS by a hash, sorted
by label within a shard, with components in descending order of the shard's own weight; the shards are stored once.
Anchors come in blocks of about ANCHOR_ROWS, and every shard is joined with one block at a time.

A join asks for all rows that score at least a threshold with an anchor. Components of a row from a place on, whose
norm cannot reach the threshold with any anchor of the block, are not indexed: the postings of a component are
the rows that go on beyond it. Partial scores are summed over the postings, pairs that the norms of what remains
cannot lift to the threshold are dropped, and the scores of those left are worked out as whole numbers.

Two joins follow one another: the best rows of the anchor's own label (positives), then for each positive the best
rows of other labels in a window below its score. Thresholds start high and are lowered while windows are not full; a full
window's last score is the threshold for all later shards of the task, and bounds what is looked at, never what is
found. Spark ranks the tasks' windows together.

Defined results: rows without vec_id, label or vector, or with a NULL or non-finite component, take no part; rows that
repeat vec_id, label and vector count once; rows under an anchor's vec_id are never its positives or negatives, and
anchors of one vec_id with other vectors or labels are mined each; shorter vectors count as filled up with
zeros; 256 * x is cut as in vector codes; ties go to the smaller vec_id; a positive without rows in its window (as one of
negative score) gives no rows; an empty table gives none; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from partflow.llm.common import stored
from partflow.llm.vector_codes import whole_numbers
from partflow.session import scratch_path
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

POSITIVES, NEGATIVES = 5, 3
#: Per cent of the positive's score between which a negative's score lies, both included.
LEAST, MOST = 50, 95
SHARD_ROWS, ANCHOR_ROWS = 2048, 8192
#: Anchors that share one matrix of partial scores, components summed at a time, and the share of pairs worth leaving it for.
TOGETHER, STEP, FEW = 64, 8, 0.1
#: Shards up to this number are dealt out evenly before a join; more are read as they lie.
DEALT = 512
#: Thresholds as shares of the largest possible score, then of no limit at all.
POSITIVE_LEVELS, NEGATIVE_LEVELS = (0.5, 0.3, 0.15, 0.0), (0.97, 0.85, 0.6)
NONE = np.iinfo(np.int64).min


def suffix_norms(numbers: np.ndarray) -> np.ndarray:
    """Norms of what remains from each place on, a little more than rounding can take away."""
    squares = np.cumsum(numbers[:, ::-1].astype(np.float64) ** 2, axis=1)[:, ::-1]
    return np.sqrt(np.concatenate((squares, np.zeros((len(numbers), 1))), axis=1)) * (1 + 1e-9)


class Shard:
    """Rows sorted by label; ``sides`` is the order of the components."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, numbers: np.ndarray, sides: np.ndarray) -> None:
        self.ids, self.labels, self.numbers, self.sides = ids, labels, numbers, sides
        self.floats, self.norms = numbers.astype(np.float64), suffix_norms(numbers)
        self.most = self.norms[:, 0].max()

    def above(self, asked: np.ndarray, norms: np.ndarray, least: np.ndarray, low: int, high: int) -> tuple[np.ndarray, ...]:
        """Query, row and score of all pairs with rows ``low`` to ``high`` that score ``least`` (one per query) or more."""
        width = asked.shape[1]
        alone = np.where(norms[:, 0] > 0, least / np.maximum(norms[:, 0], 1e-300), np.where(least > 0, np.inf, -np.inf)).min()
        # From here on a row's components are covered: with these alone no query reaches its threshold.
        stop = np.minimum((self.norms[low:high] >= alone).sum(axis=1), width)
        order = np.argsort(-stop, kind="stable")
        order = order[:np.count_nonzero(stop)]
        stop = np.minimum(-(-stop[order] // STEP) * STEP, width)
        rows, rest, floats = order + low, self.norms[low:high][order], asked.astype(np.float64)
        partial = np.zeros((len(asked), len(rows)))
        alive = np.ones_like(partial, bool)
        for first in range(0, width, STEP):
            last = min(first + STEP, width)
            posted = np.searchsorted(-stop, -first, side="left")
            partial[:, :posted] += floats[:, first:last] @ self.floats[rows[:posted], first:last].T
            if 2 * last >= width:
                upto = np.minimum(stop, last)
                alive = partial + norms[:, upto] * rest[np.arange(len(rows)), upto] + 0.5 >= least[:, None]
                if alive.mean() < FEW:
                    break
        query, place = np.nonzero(alive)
        row = rows[place]
        score = np.empty(len(row), np.int64)
        for at in range(0, len(row), chunk := max(1, 2_000_000 // width)):
            part = slice(at, at + chunk)
            score[part] = np.einsum("pw,pw->p", asked[query[part]], self.numbers[row[part]])
        reached = score >= least[query]
        return query[reached], row[reached], score[reached]


class Block(NamedTuple):
    """Anchors that are joined together."""
    ids: np.ndarray
    labels: np.ndarray
    numbers: np.ndarray


class Windows:
    """For each anchor some windows of scores, each with its best few rows so far."""

    def __init__(self, low: np.ndarray, high: np.ndarray, size: int) -> None:
        self.low, self.high = low, high
        self.open = low <= high
        self.scores, self.ids = np.full((*low.shape, size), NONE), np.full((*low.shape, size), NONE)

    def floor(self, of: np.ndarray) -> np.ndarray:
        """What a row must score to enter; a tie may enter by its id."""
        return np.maximum(self.low[of], self.scores[of, :, -1])

    def merged(self, of: np.ndarray, query: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores and ids of the windows of anchors ``of`` with more rows; ``query`` numbers these anchors."""
        all_scores, all_ids = self.scores[of], self.ids[of]
        slots, size = all_scores.shape[1:]
        floor = self.floor(of)
        new_scores, new_ids = np.full_like(all_scores, NONE), np.full_like(all_ids, NONE)
        for slot in range(slots):
            there = (scores >= floor[query, slot]) & (scores <= self.high[of][query, slot])
            old, place = np.nonzero(all_scores[:, slot] > NONE)
            group = np.concatenate((old, query[there]))
            score = np.concatenate((all_scores[old, slot, place], scores[there]))
            vec_id = np.concatenate((all_ids[old, slot, place], ids[there]))
            order = np.lexsort((vec_id, -score, group))
            group, score, vec_id = group[order], score[order], vec_id[order]
            rank = np.arange(len(group)) - np.searchsorted(group, group)
            kept = rank < size
            new_scores[group[kept], slot, rank[kept]] = score[kept]
            new_ids[group[kept], slot, rank[kept]] = vec_id[kept]
        return new_scores, new_ids


def fill(shard: Shard, low: int, high: int, block: Block, of: np.ndarray, windows: Windows, levels: Sequence[float], others: bool) -> None:
    """Fills the windows of anchors ``of`` from rows ``low`` to ``high``, lowering the thresholds until they are full."""
    asked = block.numbers[of][:, shard.sides]
    norms = suffix_norms(asked)
    for level in (*levels, -np.inf):
        left = windows.open[of].any(axis=1)
        of, asked, norms = of[left], asked[left], norms[left]
        if not len(of):
            return
        floor = windows.floor(of).astype(np.float64)
        top = np.minimum(windows.high[of], norms[:, :1] * shard.most)
        wanted = np.maximum(floor, np.where(top > 0, level * top, -np.inf))
        least = np.where(windows.open[of], wanted, np.inf).min(axis=1)
        query, row, score = shard.above(asked, norms, least, low, high)
        apart = shard.ids[row] != block.ids[of[query]]
        if others:
            apart &= shard.labels[row] != block.labels[of[query]]
        query, row, score = query[apart], row[apart], score[apart]
        scores, ids = windows.merged(of, query, shard.ids[row], score)
        full = ((wanted <= floor) | (scores[:, :, -1] >= least[:, None]) | ~windows.open[of]).all(axis=1)
        windows.scores[of[full]], windows.ids[of[full]] = scores[full], ids[full]
        of, asked, norms = of[~full], asked[~full], norms[~full]


def join(shard: Shard, block: Block, windows: Windows, others: bool) -> None:
    """Rows of the anchor's own label, or of all others, of one shard."""
    if others:
        for at in range(0, len(block.ids), TOGETHER):
            fill(shard, 0, len(shard.ids), block, np.arange(at, min(at + TOGETHER, len(block.ids))), windows, NEGATIVE_LEVELS, True)
        return
    for label in np.intersect1d(shard.labels, block.labels):
        low, high = np.searchsorted(shard.labels, label, side="left"), np.searchsorted(shard.labels, label, side="right")
        of = np.flatnonzero(block.labels == label)
        for at in range(0, len(of), TOGETHER):
            fill(shard, low, high, block, of[at:at + TOGETHER], windows, POSITIVE_LEVELS, False)


def usable(embeddings: DataFrame) -> DataFrame:
    """vec_id, label and whole numbers of the rows that take part, once each."""
    vector, limit = F.col("embedding").cast("array<double>"), F.lit(float("inf"))
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < limit))
    rows = embeddings.where("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL").where(F.coalesce(finite, F.lit(False)))
    return rows.select("vec_id", "label", whole_numbers(F.col("embedding")).alias("numbers")).dropDuplicates()


def filled(column: pa.Array, width: int) -> np.ndarray:
    """Lists of whole numbers as a matrix, short ones filled up with zeros."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(lists), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


def indexed(rows: DataFrame, width: int, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Shards: vec_ids, labels, numbers (row, component) and sides."""
    schema = T.StructType([
        T.StructField("vec_ids", T.ArrayType(T.LongType())), T.StructField("labels", T.ArrayType(rows.schema["label"].dataType)),
        T.StructField("numbers", T.BinaryType()), T.StructField("sides", T.ArrayType(T.IntegerType()))])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), shard_rows):
                shard = batch.slice(at, shard_rows)
                numbers = filled(shard.column(2), width)
                order = np.argsort(shard.column(1).to_numpy(zero_copy_only=False), kind="stable")
                sides = np.argsort(-(numbers.astype(np.float64) ** 2).sum(axis=0), kind="stable")
                ends = pa.array([0, len(shard)], pa.int32())
                yield pa.RecordBatch.from_arrays([
                    *(pa.ListArray.from_arrays(ends, shard.column(k).take(pa.array(order))) for k in (0, 1)),
                    pa.array([numbers[order][:, sides].astype("<i4").tobytes()]), pa.array([sides.tolist()], pa.list_(pa.int32()))], schema.names)

    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), "label", "numbers").mapInArrow(pack, schema)


def shards_of(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[Shard]:
    for batch in batches:
        for row in range(len(batch)):
            ids, labels, numbers, sides = (batch.column(k)[row] for k in range(4))
            yield Shard(ids.values.to_numpy(), labels.values.to_numpy(zero_copy_only=False),
                        np.frombuffer(numbers.as_buffer(), "<i4").astype(np.int64).reshape(-1, width), sides.values.to_numpy())


def best_rows(shards: DataFrame, block: Block, low: np.ndarray, high: np.ndarray, size: int, others: bool) -> DataFrame:
    """query, slot, rank, vec_id, score: the best rows in each window of each anchor of a block."""
    width = block.numbers.shape[1]
    names = ["query", "slot", "vec_id", "score"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = Windows(low, high, size)
        for shard in shards_of(batches, width):
            join(shard, block, windows, others)
        query, slot, place = np.nonzero(windows.scores > NONE)
        yield pa.RecordBatch.from_arrays([
            pa.array(query, pa.int64()), pa.array(slot, pa.int64()), pa.array(windows.ids[query, slot, place], pa.int64()),
            pa.array(windows.scores[query, slot, place], pa.int64())], names)

    found = shards.mapInArrow(scan, "query long, slot long, vec_id long, score long")
    order = Window.partitionBy("query", "slot").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= size)


def mine_block(shards: DataFrame, block: Block, positives: int, negatives: int, least: int, most: int) -> DataFrame:
    """Hard negatives of the anchors of one block. The driver gets ``positives`` rows per anchor of the block."""
    n = len(block.ids)
    everything = (np.full((n, 1), NONE), np.full((n, 1), np.iinfo(np.int64).max))
    found = best_rows(shards, block, *everything, positives, others=False).toPandas()
    query, slot = found["query"].to_numpy(), found["rank"].to_numpy() - 1
    score, vec_id = np.zeros((n, positives), np.int64), np.zeros((n, positives), np.int64)
    there = np.zeros((n, positives), bool)
    score[query, slot], vec_id[query, slot], there[query, slot] = found["score"], found["vec_id"], True
    low, high = np.where(there, -(-least * score // 100), 1), np.where(there, most * score // 100, 0)
    spark = shards.sparkSession
    given = pa.table([np.repeat(np.arange(n), positives), np.tile(np.arange(positives), n), np.repeat(block.ids, positives),
                      vec_id.reshape(-1), score.reshape(-1)], ["query", "slot", "anchor_id", "positive_id", "positive_score"])
    rows = best_rows(shards, block, low, high, negatives, others=True)
    return rows.join(F.broadcast(spark.createDataFrame(given)), ["query", "slot"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))


def mine(embeddings: DataFrame, anchors: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, least: int = LEAST,
         most: int = MOST, shard_rows: int = SHARD_ROWS, anchor_rows: int = ANCHOR_ROWS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for the rows that ``anchors`` is true of."""
    spark = embeddings.sparkSession
    width = max(1, embeddings.agg(F.max(F.size("embedding"))).first()[0] or 1)
    shards = stored(indexed(usable(embeddings), width, shard_rows), "negative-index")
    if (count := shards.count()) <= DEALT:
        shards = stored(shards.repartition(max(1, count)), "negative-index")
    asked = usable(embeddings.where(anchors))
    blocks = max(1, -(-asked.count() // anchor_rows))
    asked = stored(asked.withColumn("block", F.pmod(F.xxhash64("vec_id", "label", "numbers"), F.lit(blocks)).cast("int")), "anchors")
    folder = scratch_path(spark, "hard-negatives")
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    spark.createDataFrame([], schema).write.parquet(f"{folder}/block=-1")
    for number in range(blocks):
        # About anchor_rows rows.
        part = asked.where(F.col("block") == number).select(F.col("vec_id").cast("long"), "label", "numbers").toArrow()
        if len(part):
            block = Block(part.column(0).to_numpy(), part.column(1).to_numpy(), filled(part.column(2), width))
            mine_block(shards, block, positives, negatives, least, most).write.parquet(f"{folder}/block={number}")
    return spark.read.schema(f"{schema}, block int").parquet(folder).drop("block")


def mine_fiftieths(embeddings: DataFrame) -> DataFrame:
    """Anchors are the rows whose vec_id is divisible by 50; where it is divisible by 7 the label is another one."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label").cast("long"))
    return mine(embeddings.select("vec_id", "embedding", label.alias("label")), F.col("vec_id") % 50 == 0)

"""Vector codes: product quantisation trained and applied with whole numbers, by Lloyd rounds over two trees.

Every component x becomes floor(256 * x) and a vector is cut into equal consecutive parts with a codebook each.
Vectors are packed into shards of at most SHARD_ROWS. A shard has one tree per part over its vectors' pieces (halved
along the widest side), built once and stored with the shard, and the codebooks get trees of the same kind.
A round takes both trees down together: from the bounding boxes of a pair of nodes come the least and the
largest distance between their points; a pair whose least distance exceeds the smallest largest distance is left out;
a node with one entry left goes to it as a whole, by its cached sum and count; in leaves where several
entries are left the distances are worked out. All of that is exact: bounds, sums and distances are whole numbers,
and bounds that are equal decide nothing, so ties go to the lower index as they do entry by entry.

Tasks return sums per entry and component, which Spark adds up; the driver holds the codebooks only.

Defined results: rows whose vector is NULL or holds NULL or a non-finite number are left out; vectors shorter than the
longest, or of a length that the parts do not divide, count as filled up with zeros (an empty one is all zeros);
256 * x is cut to +-LIMIT; vec_id may be NULL (last in order) or repeated (then by the vector); repeated rows count
each; with fewer rows than entries the codebooks are as short; entries without members stay as they are; an empty
table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from partflow.llm.common import stored
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PARTS, ENTRIES, ROUNDS = 16, 64, 2
SHARD_ROWS, LEAF = 4096, 32
#: Keeps squared distances of up to 8192 components within 64 bits.
LIMIT = 2 ** 23
#: Labels up to this number are broadcast with their sums.
BROADCAST_LABELS = 100_000


class Shape(NamedTuple):
    """Nodes of a balanced tree over ``n`` places, level by level; children are 0 in leaves."""
    low: np.ndarray
    high: np.ndarray
    left: np.ndarray
    right: np.ndarray
    #: Per level the nodes that cover all places, earlier leaves included.
    levels: list[np.ndarray]


@lru_cache(64)
def shape_of(n: int, leaf: int) -> Shape:
    low, high, left, right, levels, level = [0], [n], [0], [0], [], [0]
    while True:
        levels.append(np.array(level))
        below = []
        for node in level:
            if high[node] - low[node] <= leaf:
                below.append(node)
                continue
            half = (low[node] + high[node]) // 2
            for side, (a, b) in ((left, (low[node], half)), (right, (half, high[node]))):
                side[node] = len(low)
                below.append(len(low))
                low.append(a)
                high.append(b)
                left.append(0)
                right.append(0)
        if below == level:
            return Shape(*map(np.array, (low, high, left, right)), levels)
        level = below


def plant(points: np.ndarray, leaf: int) -> tuple[np.ndarray, np.ndarray]:
    """Points (part, row, component) in the order of their trees, and that order."""
    n = points.shape[1]
    shape = shape_of(n, leaf)
    order = np.broadcast_to(np.arange(n), points.shape[:2])
    for level in shape.levels[:-1]:
        starts, sizes = shape.low[level], shape.high[level] - shape.low[level]
        wide = np.maximum.reduceat(points, starts, axis=1) - np.minimum.reduceat(points, starts, axis=1)
        side = np.repeat(wide.argmax(axis=2), sizes, axis=1)
        key = np.take_along_axis(points, side[..., None], 2)[..., 0]
        sort = np.lexsort((key, np.broadcast_to(np.repeat(np.arange(len(level)), sizes), key.shape)))
        points, order = np.take_along_axis(points, sort[..., None], 1), np.take_along_axis(order, sort, 1)
    return points, order


class Forest:
    """One tree per part over points that are in the order of their trees."""

    def __init__(self, points: np.ndarray, leaf: int) -> None:
        self.points, self.shape = points, shape_of(points.shape[1], leaf)
        parts, _, width = points.shape
        self.box_low = np.empty((parts, len(self.shape.low), width), np.int64)
        self.box_high = np.empty_like(self.box_low)
        for level in self.shape.levels:
            self.box_low[:, level] = np.minimum.reduceat(points, self.shape.low[level], axis=1)
            self.box_high[:, level] = np.maximum.reduceat(points, self.shape.low[level], axis=1)
        self.extent = ((self.box_high - self.box_low) ** 2).sum(axis=2)

    def sums(self) -> np.ndarray:
        upto = np.concatenate((np.zeros_like(self.points[:, :1]), np.cumsum(self.points, axis=1)), axis=1)
        return upto[:, self.shape.high] - upto[:, self.shape.low]


class Assigned(NamedTuple):
    """Whole nodes and single points with their entries."""
    node_part: np.ndarray
    node: np.ndarray
    node_entry: np.ndarray
    point_part: np.ndarray
    point: np.ndarray
    point_entry: np.ndarray


def spread(low: np.ndarray, size: np.ndarray) -> np.ndarray:
    """low, low + 1, ... for ``size`` places each, one range after the other."""
    ends = np.cumsum(size)
    return np.repeat(low - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)


def squared(apart: np.ndarray) -> np.ndarray:
    """Squared lengths of rows."""
    return np.einsum("nw,nw->n", apart, apart)


def meet(forest: Forest, books: np.ndarray) -> Assigned:
    """The nearest entry of every point: both trees are taken down together."""
    ordered, order = plant(books, 1)
    entries = Forest(ordered, 1)
    tree, book = forest.shape, entries.shape
    part = np.arange(len(books))
    node, other = np.zeros_like(part), np.zeros_like(part)
    whole, single = [], []
    while len(part):
        groups = np.flatnonzero(np.append(True, (part[1:] != part[:-1]) | (node[1:] != node[:-1])))
        sizes = np.diff(np.append(groups, len(part)))
        low, high = forest.box_low[part, node], forest.box_high[part, node]
        entry_low, entry_high = entries.box_low[part, other], entries.box_high[part, other]
        least = squared(np.maximum(0, np.maximum(entry_low - high, low - entry_high)))
        most = squared(np.maximum(high - entry_low, entry_high - low))
        left = least <= np.repeat(np.minimum.reduceat(most, groups), sizes)
        group = np.repeat(np.arange(len(groups)), sizes)[left]
        part, node, other = part[left], node[left], other[left]
        starts = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
        sizes = np.diff(np.append(starts, len(part)))
        entry_size = np.where(book.left[other] > 0, entries.extent[part, other], -1)
        widest = np.maximum.reduceat(entry_size, starts)
        head_part, head_node = part[starts], node[starts]
        inner = tree.left[head_node] > 0
        done = (sizes == 1) & (widest < 0)
        halve = ~done & inner & ((widest < 0) | (forest.extent[head_part, head_node] >= widest))
        leaf = ~done & ~halve & (widest < 0)
        done, halve, leaf = (np.repeat(mark, sizes) for mark in (done, halve, leaf))
        whole.append((part[done], node[done], order[part[done], book.low[other[done]]]))
        if leaf.any():
            single.append(nearest_of(forest, books, part[leaf], node[leaf], order[part[leaf], book.low[other[leaf]]]))
        # What is left goes on: halves of the node with the same entries, or the node with halves of its entries.
        branch = ~done & ~halve & ~leaf & (book.left[other] > 0)
        stay = ~done & ~halve & ~leaf & (book.left[other] == 0)
        part, node, other = (np.concatenate(columns) for columns in zip(
            (part[halve], tree.left[node[halve]], other[halve]), (part[halve], tree.right[node[halve]], other[halve]),
            (part[branch], node[branch], book.left[other[branch]]), (part[branch], node[branch], book.right[other[branch]]),
            (part[stay], node[stay], other[stay]), strict=True))
        again = np.lexsort((node, part))
        part, node, other = part[again], node[again], other[again]
    none = [(np.zeros(0, np.int64),) * 3]
    return Assigned(*map(np.concatenate, zip(*whole, strict=True)), *map(np.concatenate, zip(*(single or none), strict=True)))


def nearest_of(forest: Forest, books: np.ndarray, part: np.ndarray, node: np.ndarray, entry: np.ndarray) -> tuple:
    """Points of leaves with the nearest of the leaves' own entries: one entry of every leaf at a time, in ascending order."""
    order = np.lexsort((entry, node, part))
    part, node, entry = part[order], node[order], entry[order]
    heads = np.flatnonzero(np.append(True, (part[1:] != part[:-1]) | (node[1:] != node[:-1])))
    # Leaves with most entries first, so that those that still have one are in front.
    counts = np.diff(np.append(heads, len(part)))
    most = np.argsort(-counts, kind="stable")
    heads, counts = heads[most], counts[most]
    size = forest.shape.high[node[heads]] - forest.shape.low[node[heads]]
    point, leaf = spread(forest.shape.low[node[heads]], size), np.repeat(np.arange(len(heads)), size)
    ends, of_part = np.cumsum(size), part[heads][leaf]
    places = forest.points[of_part, point]
    best, chosen = np.full(len(point), np.iinfo(np.int64).max), np.zeros(len(point), np.int64)
    for nth in range(counts[0]):
        there = ends[np.searchsorted(-counts, -nth, side="left") - 1]
        now = entry[heads[leaf[:there]] + nth]
        away = squared(places[:there] - books[of_part[:there], now])
        nearer = np.flatnonzero(away < best[:there])
        best[nearer], chosen[nearer] = away[nearer], now[nearer]
    return of_part, point, chosen


def tally(forest: Forest, books: np.ndarray, counts: np.ndarray, totals: np.ndarray) -> None:
    """Adds the shard's members to counts (part, entry) and totals (part, entry, component)."""
    found = meet(forest, books)
    size = forest.shape.high - forest.shape.low
    np.add.at(counts, (found.node_part, found.node_entry), size[found.node])
    np.add.at(totals, (found.node_part, found.node_entry), forest.sums()[found.node_part, found.node])
    np.add.at(counts, (found.point_part, found.point_entry), 1)
    np.add.at(totals, (found.point_part, found.point_entry), forest.points[found.point_part, found.point])


def codes_of(forest: Forest, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entry and squared distance of every point, in the trees' order."""
    found = meet(forest, books)
    codes = np.zeros(forest.points.shape[:2], np.int64)
    low, size = forest.shape.low[found.node], (forest.shape.high - forest.shape.low)[found.node]
    codes[np.repeat(found.node_part, size), spread(low, size)] = np.repeat(found.node_entry, size)
    codes[found.point_part, found.point] = found.point_entry
    chosen = books[np.arange(len(books))[:, None], codes]
    return codes, ((forest.points - chosen) ** 2).sum(axis=2)


def whole_numbers(embedding: Column) -> Column:
    """floor(256 * x) of every component, cut to +-LIMIT."""
    limit = F.lit(float(LIMIT))
    return F.transform(embedding.cast("array<double>"), lambda x: F.floor(F.greatest(F.least(x * 256, limit), -limit)).cast("int"))


def usable(embeddings: DataFrame, parts: int) -> DataFrame:
    """vec_id, label and the whole numbers of the rows that take part, all of one length that ``parts`` divides."""
    vector, limit = F.col("embedding").cast("array<double>"), F.lit(float("inf"))
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < limit))
    rows = embeddings.where(F.col("embedding").isNotNull()).where(F.coalesce(finite, F.lit(False))).select(
        "vec_id", "label", whole_numbers(F.col("embedding")).alias("numbers"))
    sizes = rows.agg(F.min(F.size("numbers")), F.max(F.size("numbers"))).first()
    width = max(1, -(-(sizes[1] or 0) // parts)) * parts
    if sizes[0] == width:
        return rows
    return rows.withColumn("numbers", F.concat("numbers", F.array_repeat(F.lit(0), F.lit(width) - F.size("numbers"))))


def first_books(rows: DataFrame, parts: int, entries: int) -> np.ndarray:
    """Codebooks (part, entry, component) from the rows of smallest vec_id."""
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "numbers").select("numbers").limit(entries).collect()
    if not first:
        return np.zeros((parts, 0, 1), np.int64)
    return np.array([row.numbers for row in first], np.int64).reshape(len(first), parts, -1).transpose(1, 0, 2)


def planted(rows: DataFrame, parts: int, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Shards with their trees: vec_ids, labels, points (part, row, component) in tree order, order (part, row)."""
    schema = T.StructType([
        T.StructField("vec_ids", T.ArrayType(rows.schema["vec_id"].dataType)), T.StructField("labels", T.ArrayType(rows.schema["label"].dataType)),
        T.StructField("points", T.BinaryType()), T.StructField("order", T.BinaryType())])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), shard_rows):
                shard = batch.slice(at, shard_rows)
                n = len(shard)
                numbers = shard.column(2).flatten().to_numpy().astype(np.int64)
                points, order = plant(numbers.reshape(n, parts, -1).transpose(1, 0, 2), LEAF)
                yield pa.RecordBatch.from_arrays([
                    *(pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), shard.column(k)) for k in (0, 1)),
                    pa.array([points.astype("<i4").tobytes()]), pa.array([order.astype("<i4").tobytes()])], schema.names)

    return rows.mapInArrow(pack, schema)


def forest_of(shard: pa.RecordBatch, row: int, column: int, parts: int, width: int) -> Forest:
    points = np.frombuffer(shard.column(column)[row].as_buffer(), "<i4").astype(np.int64)
    return Forest(points.reshape(parts, -1, width), LEAF)


def lloyd_round(shards: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after one round; the driver gets one row per entry and component."""
    parts, _, width = books.shape

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, totals = np.zeros(books.shape[:2], np.int64), np.zeros(books.shape, np.int64)
        for batch in batches:
            for row in range(len(batch)):
                tally(forest_of(batch, row, 0, parts, width), books, counts, totals)
        part, entry = np.nonzero(counts)
        part, entry, place = np.repeat(part, width), np.repeat(entry, width), np.tile(np.arange(width), len(part))
        yield pa.RecordBatch.from_arrays(
            [pa.array(column, pa.int64()) for column in (part, entry, place, counts[part, entry], totals[part, entry, place])],
            ["part", "entry", "place", "n", "total"])

    sums = shards.select("points").mapInArrow(scan, "part long, entry long, place long, n long, total long")
    out = books.copy()
    for row in sums.groupBy("part", "entry", "place").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect():
        out[row.part, row.entry, row.place] = row.total // row.n
    return out


def encode_vectors(embeddings: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
                   shard_rows: int = SHARD_ROWS) -> tuple[DataFrame, np.ndarray]:
    """vec_id, label, code (two hex digits a part) and error of every row, and the codebooks (part, entry, component)."""
    if not 0 < entries <= 256:
        raise ValueError("a code has two hex digits")
    rows = usable(embeddings, parts)
    books = first_books(rows, parts, entries)
    shards = stored(planted(rows, parts, shard_rows), "vector-trees")
    if books.shape[1]:
        for _ in range(rounds):
            books = lloyd_round(shards, books)
    schema = T.StructType([rows.schema["vec_id"], rows.schema["label"], T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(len(batch)):
                codes, away = codes_of(forest_of(batch, row, 2, parts, books.shape[2]), books)
                order = np.frombuffer(batch.column(3)[row].as_buffer(), "<i4").reshape(parts, -1)
                of_row, error = np.empty_like(codes), np.empty_like(away)
                np.put_along_axis(of_row, order, codes, 1)
                np.put_along_axis(error, order, away, 1)
                spelled = of_row.T.astype(np.uint8).tobytes().hex()
                yield pa.RecordBatch.from_arrays([
                    batch.column(0)[row].values, batch.column(1)[row].values,
                    pa.array([spelled[at:at + 2 * parts] for at in range(0, len(spelled), 2 * parts)], pa.string()),
                    pa.array(error.sum(axis=0), pa.int64())], schema.names)

    return shards.mapInArrow(scan, schema), books


def books_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def digest_codes(embeddings: DataFrame) -> DataFrame:
    """vec_id, code, error, label_error (summed over equal labels, NULL ones together) and codebooks_sha256."""
    coded, books = encode_vectors(embeddings)
    coded = stored(coded, "vector-codes")
    sums = coded.groupBy(F.col("label").alias("of_label")).agg(F.sum("error").alias("label_error"))
    if sums.count() <= BROADCAST_LABELS:
        sums = F.broadcast(sums)
    joined = coded.join(sums, F.col("label").eqNullSafe(F.col("of_label")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256"))

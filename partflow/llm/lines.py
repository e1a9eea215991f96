"""Line deduplication across documents: equal and nearly equal lines are kept once.

A line is lower-cased, runs of white space are one blank, and a blank line is left alone. Lines that are equal then,
with their digits and signs, are one value however often they occur. A value has a SimHash of its distinct words,
with every digit as 0 where so few are digits that other ones leave the lines similar; values that share three of six
blocks of it and differ in at most eight bits are candidates (three differing bits always leave three blocks whole,
more leave them often), and candidates whose edit similarity is at least 0.8 are linked.
Of each connected group of lines the first occurrence by doc_id (NULL last), then place, stays.

Values of one SimHash stand in the buckets once, and no bucket is paired out. First every member of a bucket is
compared with one seeded member, twice, which joins a group of variants in a number of pairs that grows with the
bucket; then only values of the same bucket in different groups are compared with each other. The groups are those
of all pairs of candidates.

Defined results: NULL texts stay NULL and empty ones empty; a document whose lines all go stays with an empty
text; rows that repeat a doc_id and text are one document and share its decisions; very long lines are
lines like any other; all columns of ``docs`` are kept, n_chars is set anew where there is one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from partflow.llm.common import let, same, stored, text_tag, unused
from partflow.llm.graph import components
from partflow.llm.simhash import SEED, fingerprint
from partflow.session import settle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh3_128_digest, xxh64_intdigest

BLOCKS, WHOLE, BITS_APART, SIMILARITY, STARS = 6, 3, 8, 0.8, 2
#: Values that have company are sent to every executor up to this many (60 bytes each); beyond, they are joined by a shuffle.
BROADCAST_VALUES = 200_000
WORD, DIGIT = re.compile(r"\w+"), re.compile(r"\d")


def normal(line: str) -> str:
    """The line as it is compared; empty for a blank one."""
    return " ".join(line.lower().split())


def words_of(value: str) -> set[str]:
    """The distinct words: counted as often as they occur, the common words of a language would make long lines alike.

    Digits count as 0 if lines that differ in them alone are similar; rows of a number table would crowd one bucket.
    """
    digits = len(DIGIT.findall(value))
    if digits and digits <= (1 - SIMILARITY) * len(value) + 1e-9:
        value = DIGIT.sub("0", value)
    return set(WORD.findall(value) or value.split())


class WordHashes(dict):
    """64 bits of a word, kept while a task meets fewer than LIMIT others."""

    LIMIT = 500_000

    def __missing__(self, word: str) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        self[word] = found = xxh64_intdigest(word.encode(), SEED)
        return found


def marks_of(values: list[str], known: WordHashes) -> np.ndarray:
    """The SimHash of every value: a bit is 1 if set in over half its words."""
    marks = np.zeros(len(values), np.int64)
    hashes: list[int] = []
    rows: list[int] = []
    counts: list[int] = []

    def flush() -> None:
        if rows:
            bits = np.unpackbits(np.array(hashes, np.uint64).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            # Eight counters of a byte in a number: at most 255 words of a value are added up this way.
            sums = np.add.reduceat(bits.view(np.uint64), np.cumsum([0, *counts[:-1]]), axis=0).view(np.uint8)
            often = 2 * sums.astype(np.int32) > np.array(counts)[:, None]
            marks[rows] = np.packbits(often, axis=1, bitorder="little").view(np.int64)[:, 0]
            hashes.clear(), rows.clear(), counts.clear()

    for row, value in enumerate(values):
        words = words_of(value)
        if len(words) > 255:
            marks[row] = fingerprint(" ".join(words).encode(), 1)
            continue
        hashes.extend(map(known.__getitem__, words))
        rows.append(row)
        counts.append(len(words))
        if len(hashes) >= 50_000:
            flush()
    flush()
    return marks


def occurrences(docs: DataFrame) -> DataFrame:
    """A row per line that is not blank: doc_id, tag, place, key (128 bits of its value), mark (SimHash), size."""
    rows = docs.select("doc_id", text_tag(F.col("text")).alias("tag"), "text").where(F.col("text").isNotNull())
    schema = T.StructType([*rows.schema.fields[:2], *[T.StructField(name, kind) for name, kind in (
        ("place", T.IntegerType()), ("key", T.BinaryType()), ("mark", T.LongType()), ("size", T.IntegerType()))]])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            owners, places, values = [], [], []
            for owner, text in enumerate(batch.column(2).to_pylist()):
                for place, line in enumerate(text.split("\n")):
                    if value := normal(line):
                        owners.append(owner)
                        places.append(place)
                        values.append(value)
            keys = [xxh3_128_digest(value.encode()) for value in values]
            marks, sizes = marks_of(values, known), list(map(len, values))
            at = pa.array(owners, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at), pa.array(places, pa.int32()),
                 pa.array(keys, pa.binary()), pa.array(marks, pa.int64()), pa.array(sizes, pa.int32())], schema.names)

    return rows.mapInArrow(scan, schema)


def buckets(marks: DataFrame) -> DataFrame:
    """A row for every mark and WHOLE of its blocks: bucket (which blocks, and their bits, side by side), id and mark."""
    edges = [64 * nth // BLOCKS for nth in range(BLOCKS + 1)]
    widths = [high - low for low, high in zip(edges, edges[1:], strict=False)]

    def bucket(nth: int, chosen: tuple[int, ...]) -> Column:
        bits = F.lit(nth).cast("long")
        for block in chosen:
            part = F.shiftrightunsigned("mark", edges[block]).bitwiseAND(F.lit((1 << widths[block]) - 1))
            bits = F.shiftleft(bits, widths[block]).bitwiseOR(part)
        return bits

    keys = [bucket(nth, chosen) for nth, chosen in enumerate(combinations(range(BLOCKS), WHOLE))]
    return marks.select(F.explode(F.array(*keys)).alias("bucket"), "id", "mark")


def shared_buckets(dealt: DataFrame) -> DataFrame:
    """The members of buckets with two marks or more, but for those of two that are too far apart.

    Rows of 24 bytes are shuffled once and sorted once; a bucket holds distinct marks only, and its rows may spill.
    """
    bucket = Window.partitionBy("bucket")
    counted = dealt.withColumns({"n": F.count(F.lit(1)).over(bucket), "apart": F.bit_xor("mark").over(bucket)})
    met = counted.where((F.col("n") > 2) | ((F.col("n") == 2) & (F.bit_count("apart") <= BITS_APART)))
    seeded = [F.min(F.struct(F.xxhash64("id", F.lit(nth)).alias("seeded"), "id", "mark")).over(bucket) for nth in range(STARS)]
    return met.select("bucket", "id", "mark", F.array(*seeded).alias("heads"))


def near(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b)) <= BITS_APART


def in_order(a: Column, b: Column) -> tuple[Column, Column]:
    return F.least(a, b).alias("a"), F.greatest(a, b).alias("b")


def star_pairs(values: DataFrame, marks: DataFrame, members: DataFrame) -> DataFrame:
    """Every value with the one that stands for its mark, and that one with STARS seeded members of its buckets that are near."""
    heads = marks.select("mark", F.col("id").alias("head"))
    twins = values.join(heads, "mark").where("id <> head").select(*in_order(F.col("id"), F.col("head")))
    met = members.select("id", "mark", F.explode("heads").alias("head"))
    return met.where((F.col("id") != F.col("head.id")) & near(F.col("mark"), F.col("head.mark"))).select(
        *in_order(F.col("id"), F.col("head.id"))).unionByName(twins).distinct()


def cross_pairs(values: DataFrame, members: DataFrame, groups: DataFrame) -> DataFrame:
    """Values of one mark, or of near marks of a bucket, that are in different groups."""
    known = groups.select(F.xxhash64("node").alias("id"), F.xxhash64("component").alias("component"))
    placed = stored(values.join(known, "id", "left").select("id", "mark", F.coalesce("component", "id").alias("component")),
                    "line-placed")
    spans = placed.groupBy("mark").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    dealt = stored(members.select("bucket", "mark").join(spans, "mark"), "line-spans")
    mixed = dealt.groupBy("bucket").agg(F.min("low").alias("least"), F.max("high").alias("most")).where("least <> most")
    left = dealt.join(mixed.select("bucket"), "bucket")
    x, y = (left.select("bucket", *[F.col(name).alias(f"{side}_{name}") for name in ("mark", "low", "high")]) for side in "xy")
    apart = F.least("x_low", "y_low") != F.greatest("x_high", "y_high")
    marks = x.join(y, "bucket").where((F.col("x_mark") < F.col("y_mark")) & near(F.col("x_mark"), F.col("y_mark")) & apart).select(
        "x_mark", "y_mark").distinct()
    own = spans.where("low <> high").select(F.col("mark").alias("x_mark"), F.col("mark").alias("y_mark"))
    for side in "xy":
        ends = placed.select(*[F.col(name).alias(f"{side}_{name}") for name in ("mark", "id", "component")])
        marks = (marks.unionByName(own) if side == "x" else marks).join(ends, f"{side}_mark")
    return marks.where("x_id <> y_id and x_component <> y_component").select(*in_order(F.col("x_id"), F.col("y_id"))).distinct()


def few(rows: DataFrame) -> DataFrame:
    return F.broadcast(rows) if rows.count() <= BROADCAST_VALUES else rows


def line_values(docs: DataFrame, places: DataFrame) -> DataFrame:
    """key and value of the lines at ``places`` (doc_id, tag, place, key)."""
    rows = docs.select("doc_id", text_tag(F.col("text")).alias("tag"), "text")
    lines = rows.join(places, same(rows, places, "doc_id", "tag")).select(
        "key", F.get(F.split("text", "\n"), F.col("place")).alias("line"))

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = pa.array([normal(line) for line in batch.column(1).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), values], ["key", "value"])

    return lines.mapInArrow(spell, "key binary, value string").dropDuplicates(["key"])


def shared_start(a: str, b: str) -> int:
    """How many characters two texts start with alike."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        half = (low + high + 1) // 2
        low, high = (half, high) if a[low:half] == b[low:half] else (low, half - 1)
    return low


def middle(a: str, b: str) -> tuple[str, str]:
    """Both texts without what they start and end with alike, which leaves their edit distance as it is."""
    start = shared_start(a, b)
    a, b = a[start:], b[start:]
    end = shared_start(a[::-1], b[::-1])
    return a[: len(a) - end], b[: len(b) - end]


def middles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        cut = [middle(a, b) for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
        columns = [pa.array([pair[side] for pair in cut], pa.string()) for side in (0, 1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns, batch.column(4)], batch.schema.names)


def verified(docs: DataFrame, found: DataFrame, values: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (a, b) of keys whose values have edit similarity SIMILARITY or more, of pairs of ids."""
    pairs = stored(pairs, "line-pairs")
    wanted = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()
    # Any occurrence will do: all have the same value. Two values of one id are both looked at.
    named = stored(values.join(wanted, "id").select("id", "key", "size"), "line-named")
    places = stored(found.join(few(named).select("key"), "key", "left_semi").groupBy("key").agg(
        F.first(F.struct("doc_id", "tag", "place")).alias("at")).select("key", "at.*"), "line-places")
    texts = settle(line_values(docs, few(places)).join(named, "key"))
    left, right = (texts.select(F.col("id").alias(side), *[F.col(name).alias(f"{side}_{name}") for name in ("key", "size", "value")])
                   for side in "ab")
    limit = F.floor(round(1 - SIMILARITY, 6) * F.greatest(F.length("a_value"), F.length("b_value"))).cast("int")
    both = pairs.join(left, "a").join(right, "b").where(
        F.least("a_size", "b_size") >= SIMILARITY * F.greatest("a_size", "b_size"))
    cut = both.select("a_key", "b_key", "a_value", "b_value", limit.alias("most")).mapInArrow(
        middles, "a_key binary, b_key binary, a_value string, b_value string, most int")
    return cut.where(F.expr("levenshtein(a_value, b_value, most)") >= 0).select(F.col("a_key").alias("a"), F.col("b_key").alias("b"))


def line_groups(docs: DataFrame, found: DataFrame) -> DataFrame:
    """node and component: the group of every line value that is linked to another one."""
    values = stored(found.groupBy("key").agg(F.first("mark").alias("mark"), F.first("size").alias("size")).withColumn(
        "id", F.xxhash64("key")), "line-values")
    marks = stored(values.groupBy("mark").agg(F.min("id").alias("id")), "line-marks")
    members = stored(shared_buckets(buckets(marks)), "line-members")
    linked = settle(verified(docs, found, values, star_pairs(values, marks, members)))
    groups = components(linked, "a", "b")
    rest = verified(docs, found, values, cross_pairs(values, members, groups))
    return components(linked.unionByName(rest), "a", "b")


def dropped_lines(docs: DataFrame) -> DataFrame:
    """doc_id, tag and places of the lines that go."""
    found = stored(occurrences(docs), "lines")
    groups = stored(line_groups(docs, found), "line-groups")
    at = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "place", "tag")
    owned = found.join(groups, found["key"] == groups["node"], "left").select(
        "doc_id", "tag", "place", F.coalesce("component", "key").alias("group"), at.alias("at"))
    firsts = stored(owned.groupBy("group").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1"), "line-firsts")
    later = owned.join(firsts.select("group", "first"), "group").where(~F.col("at").eqNullSafe(F.col("first")))
    return later.groupBy("doc_id", "tag").agg(F.collect_set("place").alias("places"))


def keep_lines(text: Column, places: Column) -> Column:
    """The text without the lines at ``places``."""
    return let(F.split(text, "\n"), lambda lines: F.array_join(F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), places), lambda at: F.get(lines, at)), "\n"))


def dedupe_lines(docs: DataFrame, dropped: str | None = None) -> DataFrame:
    """``docs`` without lines that occur, equal or nearly equal, before; a column named ``dropped`` tells how many went."""
    own, owner, tag, places, text = unused(docs, "own", "owner", "tag", "places", "kept")
    gone = dropped_lines(docs).select(F.col("doc_id").alias(owner), F.col("tag").alias(tag), F.col("places").alias(places))
    tagged = docs.withColumn(own, text_tag(F.col("text")))
    joined = tagged.join(gone, tagged["doc_id"].eqNullSafe(gone[owner]) & (tagged[own] == gone[tag]), "left").withColumn(
        text, F.when(F.col(places).isNull(), F.col("text")).otherwise(keep_lines(F.col("text"), F.col(places))))
    columns = [F.col(text).alias("text") if name == "text" else F.length(text).cast(docs.schema[name].dataType).alias(name)
               if name == "n_chars" else F.col(f"`{name}`") for name in docs.columns]
    if dropped is not None:
        columns.append(F.when(F.col(places).isNull(), 0).otherwise(F.size(places)).cast("long").alias(dropped))
    return joined.select(*columns)


def digest_lines(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, lines kept and dropped, digest of the text that stays."""
    kept = dedupe_lines(docs.select("doc_id", "text"), "n_dropped")
    return kept.select("doc_id", "n_dropped", F.length("text").cast("long").alias("n_chars"), F.sha2("text", 256).alias("text_sha256"))

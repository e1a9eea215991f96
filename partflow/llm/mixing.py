"""Mixing sources to target weights by Sainte-Laguë apportionment. DataFrame functions only.

The words of a source stand in a seeded order in shards (about the root of its documents each, so that
neither a shard nor the list of shards of a hot source grows large), and each shard is cut into blocks of
equal size. Blocks are seats: they go to the sources, and within a source to its shards, by the highest
quotients ``votes / (2 k + 1)``. A shard then takes its quota of blocks at a seeded place, evenly spread;
a quota beyond its blocks takes every block once more.

Defined results: NULL text has no words; a NULL source is a source like any other, after all others; an
empty text takes none; rows that repeat a doc_id and text are rows of their own; an empty table gives an
empty mix; columns other than doc_id, source and text are not looked at by ``plan_mix``.
"""

from __future__ import annotations

from collections.abc import Sequence

from partflow.llm.common import count_words, let, split_words
from partflow.session import settle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Sources are ranked and weighed in one task, one row each; more than this many are refused, never cut.
MAX_SOURCES = 1_000_000
#: The source table is broadcast up to this many rows; beyond, it is joined by a shuffle.
BROADCAST_SOURCES = 10_000
SEED = "mix-1"


def document_sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source and size (words) of every row."""
    return docs.select("doc_id", "source", count_words(F.col("text")).alias("size"))


def source_targets(sizes: DataFrame, weights: Sequence[int] = (3, 1, 2), budget: float = 1.5,
                   repeats: int = 2) -> DataFrame:
    """One row per source: source_no, source, source_size, n_docs and the words it should give.

    Sources, in order of their code points with NULL last, take ``weights`` in turn and share ``budget``
    times all words; a target stops at ``repeats`` times the source's words, and what is above is shared
    again. That is one water level: every source not stopped gets level x weight.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    rows = (sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
            .withColumn("source_no", F.row_number().over(order) - 1)
            .withColumn("source_no", F.when(F.col("source_no") < MAX_SOURCES, F.col("source_no")).otherwise(
                F.raise_error(F.lit(f"more than {MAX_SOURCES} sources"))))
            .withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), F.col("source_no") % len(weights) + 1))
            .withColumn("cap", F.lit(repeats) * F.col("source_size")))
    # By cap per weight: the sources before the level are full, the others share what is left.
    filling = Window.orderBy(F.col("cap") / F.col("weight"), "source_no")
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    rows = (rows.withColumn("full", F.coalesce(F.sum("cap").over(before), F.lit(0)))
            .withColumn("open_weight", F.sum("weight").over(everything)
                        - F.coalesce(F.sum("weight").over(before), F.lit(0)))
            .withColumn("level", (F.lit(budget) * F.sum("source_size").over(everything) - F.col("full"))
                        / F.col("open_weight"))
            .withColumn("place", F.row_number().over(filling)))
    level = F.min(F.when(F.col("level") <= F.col("cap") / F.col("weight"),
                         F.struct("place", "level"))).over(everything)["level"]
    return rows.withColumn("target", F.least(F.col("cap").cast("double"), level * F.col("weight"))).select(
        "source_no", "source", "source_size", "n_docs", F.coalesce("target", F.lit(0.0)).alias("target"))


def apportion(rows: DataFrame, groups: list[str], key: str, votes: str, seats: str, limit: str) -> DataFrame:
    """Sainte-Laguë: ``seats`` of each group to its rows by the highest ``votes / (2 k + 1)``, at most ``limit`` each.

    The quota of a row lies close to its rounded share, so only the seats around it compete: those
    below are given without a contest, and the list of quotients stays a few per row.
    """
    whole = Window.partitionBy(*groups)
    share = F.try_divide(F.col(votes) * F.col(seats), F.col("_all"))
    near = F.floor(share + 0.5)
    open_votes = F.sum(F.when(near < F.col(limit), F.col(votes))).over(whole)
    rows = (rows.withColumn("_all", F.sum(votes).over(whole)).withColumn("_n", F.count(F.lit(1)).over(whole))
            .withColumn("_open", F.coalesce(open_votes, F.col("_all")))
            .withColumn("_reach", F.ceil(F.try_divide(F.col(votes) * F.col("_n"), F.col("_open"))) + 2)
            .withColumn("_near", F.coalesce(near, F.lit(0)).cast("long"))
            .withColumn("_reach", F.coalesce("_reach", F.lit(0)).cast("long"))
            .withColumn("_from", F.greatest(F.lit(0), F.least(F.col("_near") - F.col("_reach"), F.col(limit))))
            .withColumn("_to", F.least(F.col("_near") + F.col("_reach"), F.col(limit)))
            .withColumn("_left", F.col(seats) - F.sum("_from").over(whole)))
    seat = F.when((F.col("_to") > F.col("_from")) & (F.col(votes) > 0), F.sequence("_from", F.col("_to") - 1))
    best = Window.partitionBy(*groups).orderBy(F.col("_quotient").desc(), key)
    contest = (rows.select(*groups, key, "_left", votes, F.explode(seat).alias("_k"))
               .withColumn("_quotient", F.col(votes) / (2 * F.col("_k") + 1))
               .withColumn("_rank", F.row_number().over(best))
               .where(F.col("_rank") <= F.col("_left"))
               .groupBy(*groups, key).agg(F.count(F.lit(1)).alias("_won")))
    kept = [name for name in rows.columns if not name.startswith("_")]
    return rows.join(contest, [*groups, key], "left").select(
        *kept, (F.col("_from") + F.coalesce("_won", F.lit(0))).alias("quota"))


def digits(start: int, count: int) -> Column:
    """A part of the seeded hash as a whole number."""
    return F.conv(F.substring("_hash", start, count), 16, 10).cast("long")


def plan_mix(docs: DataFrame, weights: Sequence[int] = (3, 1, 2), budget: float = 1.5, repeats: int = 2,
             block_words: int = 32, seed: str = SEED) -> DataFrame:
    """What the mix takes of every row of ``docs``: doc_id, source, size, source_size, target, pieces, taken.

    ``pieces`` lists word ranges (start, end) with how often each is taken; ``taken`` is their sum. Blocks
    have ``block_words`` words where a source is large enough for its quota to be exact within a hundredth,
    else one word. Reruns give the same rows.
    """
    sizes = settle(document_sizes(docs))
    sources = settle(source_targets(sizes, weights, budget, repeats)
                     .withColumn("n_shards", F.ceil(F.sqrt("n_docs")).cast("long"))
                     .withColumn("unit", F.when(
                         (F.col("target") >= 64 * block_words)
                         & (F.col("source_size") >= 16 * block_words * F.col("n_shards")), block_words).otherwise(1)))
    few = sources.count() <= BROADCAST_SOURCES
    dealt = (F.broadcast(sources) if few else sources).alias("s")
    rows = (sizes.alias("d").join(dealt, F.col("d.source").eqNullSafe(F.col("s.source")))
            .select("d.doc_id", "d.source", "d.size", "s.source_no", "s.source_size", "s.target", "s.n_shards", "s.unit")
            .withColumn("_hash", F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
                                                   F.col("size").cast("string"))))
            .withColumn("shard", digits(1, 8) % F.col("n_shards"))
            .withColumn("place", digits(9, 15)).drop("_hash", "n_shards"))
    shards = (rows.groupBy("source_no", "shard").agg(F.sum("size").alias("shard_size"), F.first("unit").alias("unit"))
              .withColumn("blocks", F.greatest(F.least(F.col("shard_size"), F.lit(1)),
                                               F.round(F.col("shard_size") / F.col("unit")).cast("long")))
              .withColumn("limit", repeats * F.col("blocks")))
    quotas = shard_quotas(shards, sources)
    # Words stand one after the other within the shard; the place of a document is its first word.
    line = Window.partitionBy("source_no", "shard").orderBy("place", "doc_id", "size")
    placed = (rows.withColumn("first", F.sum("size").over(line.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
              .join(quotas.select("source_no", "shard", "shard_size", "blocks", "quota"), ["source_no", "shard"]))
    blocks, quota, size, first = (F.col(name) for name in ("blocks", "quota", "size", "first"))
    offset = F.col("shard") * 7919 % F.greatest(blocks, F.lit(1))

    def start(block: Column) -> Column:
        return F.floor(block * F.col("shard_size") / blocks)

    def times(block: Column) -> Column:
        extra = quota % blocks
        spread = F.floor((block + offset + 1) * extra / blocks) - F.floor((block + offset) * extra / blocks)
        return F.floor(quota / blocks) + spread

    low = F.greatest(F.floor(first * blocks / F.col("shard_size")) - 1, F.lit(0))
    high = F.least(F.floor((first + size) * blocks / F.col("shard_size")) + 1, blocks - 1)
    pieces = F.filter(F.transform(F.sequence(low, high), lambda block: F.struct(
        (F.greatest(start(block), first) - first).alias("start"),
        (F.least(start(block + 1), first + size) - first).alias("end"), times(block).alias("times"))),
        lambda piece: (piece["end"] > piece["start"]) & (piece["times"] > 0))
    piece_type = "array<struct<start:bigint,end:bigint,times:bigint>>"
    placed = placed.withColumn("pieces", F.coalesce(F.when(size > 0, pieces.cast(piece_type)),
                                                    F.array().cast(piece_type)))
    return placed.select("doc_id", "source", "size", "source_size", "target", "pieces", F.aggregate(
        "pieces", F.lit(0).cast("long"), lambda total, piece: total + (piece["end"] - piece["start"]) * piece["times"]
    ).alias("taken"))


def shard_quotas(shards: DataFrame, sources: DataFrame) -> DataFrame:
    """Blocks of every shard: first the blocks of a size to the sources, then a source's to its shards."""
    totals = shards.groupBy("source_no").agg(F.sum("blocks").alias("source_blocks"))
    votes = (sources.join(totals, "source_no").withColumn("source_limit", 2 * F.col("source_blocks"))
             .withColumn("votes", F.coalesce(F.try_divide(F.col("target") * F.col("source_blocks"), F.col("source_size")), F.lit(0.0)))
             .withColumn("all_seats", F.round(F.sum("votes").over(Window.partitionBy("unit"))).cast("long"))
             .select("unit", "source_no", "votes", "all_seats", "source_limit"))
    by_source = apportion(votes, ["unit"], "source_no", "votes", "all_seats", "source_limit").select(
        "source_no", F.col("quota").alias("seats"))
    return apportion(shards.join(by_source, "source_no"), ["source_no"], "shard", "blocks", "seats", "limit")


def cut_pieces(text: Column, pieces: Column) -> Column:
    """The taken word ranges of a text, words joined by a blank, one entry per piece; ``times`` tells how often."""
    return let(split_words(text), lambda known: F.transform(pieces, lambda piece: F.struct(F.array_join(
        F.slice(known, (piece["start"] + 1).cast("int"), (piece["end"] - piece["start"]).cast("int")), " "
    ).alias("text"), piece["times"].alias("times"))))

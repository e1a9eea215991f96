"""Benchmark decontamination: word windows of the test items, found in documents. DataFrame functions only.

The distinct windows of the items are the hash set: broadcast while there are at most BROADCAST_WINDOWS
of them, else joined by a shuffle. Of a document every seventh run of seven words is hashed first: a
window of thirteen holds one whole, so only where such a run is part of an item are the windows around it
hashed, looked up and compared word by word. Results of equal texts are found once and joined back, so a group of copies costs no more rows.

Defined results: NULL and empty texts have no words and are never hit; an item without words has no
window; items with NULL id can be hit but are in no list and no count; item rows that share an id are one
item; rows that repeat a doc_id are rows of their own; an empty benchmark hits nothing; other columns of
``docs`` are kept by ``decontaminate`` and not looked at by ``find_contamination``.
"""

from __future__ import annotations

from partflow.llm.common import ascii_lower, hex_digest, let, split_words, unused
from partflow.session import settle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Lower-case letters, digits and everything beyond ASCII make a word; this stands between words.
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 13
#: A window takes about 150 bytes: 64 MB at most on each executor.
BROADCAST_WINDOWS = 400_000


def words_of(text: Column) -> Column:
    return split_words(ascii_lower(text), NO_WORD)


def windows_at(words: Column, length: Column | int, step: int = 1) -> Column:
    """Hashes of the windows of ``length`` words at every ``step``-th word; NULL where there are fewer words."""
    return let(words, lambda known: F.when(F.size(known) >= length, F.transform(
        F.sequence(F.lit(0), F.size(known) - length, F.lit(step)), lambda at: F.xxhash64(F.slice(known, at + 1, length)))))


def item_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Distinct windows of the items: window_hash, length, window (its words) and item_ids."""
    items = (benchmark.select("item_id", words_of(F.col("text")).alias("words")).where(F.size("words") > 0)
             .withColumn("length", F.least(F.size("words"), F.lit(window))))
    return (items.select("item_id", "words", "length", F.posexplode(windows_at(F.col("words"), F.col("length")))
                         .alias("at", "window_hash"))
            .select("item_id", "length", "window_hash", F.slice("words", F.col("at") + 1, F.col("length")).alias("window"))
            .groupBy("window_hash", "length", "window").agg(F.collect_set("item_id").alias("item_ids")))


def find_hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Places of item windows by distinct text: text_key, hits (sorted ranges of words), item_ids (sorted strings)."""
    windows = settle(item_windows(benchmark, window))
    few = windows.count() <= BROADCAST_WINDOWS
    # At most ``window`` lengths; nearly always one.
    lengths = sorted(row["length"] for row in windows.select("length").distinct().collect())
    texts = docs.where(F.col("text").isNotNull()).select(F.md5("text").alias("text_key"), words_of(F.col("text")).alias("words"))
    found = None
    for length in lengths or [window]:
        known = windows.where(F.col("length") == length)
        # Wherever a window of 2 s - 1 words stands, s of them start at a multiple of s.
        part = (length + 1) // 2
        fragments = known.select(F.explode(windows_at(F.col("window"), part)).alias("h")).distinct()
        near = (texts.select("text_key", "words", F.posexplode(windows_at(F.col("words"), part, part)).alias("nth", "h"))
                .join(F.broadcast(fragments) if few else fragments, "h", "left_semi")
                .select("text_key", "words", (F.col("nth") * part).alias("near")))
        starts = F.sequence(F.greatest(F.col("near") - (length - part), F.lit(0)),
                            F.least(F.col("near"), F.size("words") - length))
        places = (near.where(F.size("words") >= length).select("text_key", "words", F.explode(starts).alias("at"))
                  .withColumn("place", F.slice("words", F.col("at") + 1, length)).withColumn("h", F.xxhash64("place")))
        hits = (places.join(F.broadcast(known) if few else known, F.col("h") == F.col("window_hash"))
                # Word by word, and as a range, so that the words are compared and not made a join key.
                .where(F.col("place").between(F.col("window"), F.col("window")))
                .select("text_key", "at", F.lit(length).alias("length"), "item_ids"))
        found = hits if found is None else found.unionByName(hits)
    # Equal texts give equal rows: they merge before the shuffle.
    found = found.dropDuplicates(["text_key", "at", "length"])
    # Settled, so that the join with the documents can split the copies of one text.
    return settle(found.groupBy("text_key").agg(
        F.sort_array(F.collect_list(F.struct("at", (F.col("at") + F.col("length")).alias("end")))).alias("hits"),
        F.sort_array(F.transform(F.array_distinct(F.flatten(F.collect_list("item_ids"))),
                                 lambda item: item.cast("string"))).alias("item_ids")))


def hit_words(hits: Column) -> Column:
    """Words inside at least one range of a sorted list."""
    empty = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("words"))
    return F.aggregate(hits, empty, lambda done, hit: F.struct(
        F.greatest(done["end"], hit["end"]).alias("end"),
        (done["words"] + F.greatest(F.lit(0), hit["end"] - F.greatest(done["end"], hit["at"]))).cast("long").alias("words")))["words"]


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: int = 20) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_hit, n_items, item_ids, hits, contaminated.

    A document is contaminated if a word is hit and at least one in ``share`` words is.
    """
    hits = find_hits(docs, benchmark, window)
    rows = docs.select("doc_id", F.md5("text").alias("text_key"), F.size(
        words_of(F.col("text"))).cast("long").alias("n_words"))
    n_hit = F.coalesce(hit_words(F.col("hits")), F.lit(0)).cast("long")
    item_ids = F.coalesce("item_ids", F.array().cast("array<string>"))
    return rows.join(hits, "text_key", "left").withColumn("n_hit", n_hit).select(
        "doc_id", "n_words", "n_hit", F.size(item_ids).cast("long").alias("n_items"), item_ids.alias("item_ids"), "hits",
        ((F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"))


def without_spans(text: Column, hits: Column) -> Column:
    """The text without the hit words and what stands before each of them."""
    part = r"([\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+)"
    parts = F.regexp_extract_all(text, F.lit(part), F.lit(1))
    tail = F.regexp_extract(text, r"([\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*)$", 1)
    kept = F.filter(parts, lambda _, at: ~F.exists(hits, lambda hit: (hit["at"] <= at) & (at < hit["end"])))
    return F.concat(F.array_join(kept, ""), tail)


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "documents", window: int = WINDOW,
                  share: int = 20) -> DataFrame:
    """``docs`` without contaminated documents, or with all documents and without the hit ``spans``."""
    if remove not in ("documents", "spans"):
        raise ValueError("remove is 'documents' or 'spans'")
    key, hits = unused(docs, "text_key", "hits")
    keyed = docs.withColumn(key, F.md5("text"))
    found = find_hits(docs, benchmark, window).select(F.col("text_key").alias(key), F.col("hits").alias(hits))
    joined = keyed.join(found, key, "left")
    names = [F.col(f"`{name}`") for name in docs.columns]
    if remove == "spans":
        joined = joined.withColumn("text", F.when(F.col(hits).isNull(), F.col("text")).otherwise(
            without_spans(F.col("text"), F.col(hits))))
        return joined.select(*names)
    n_words = F.size(words_of(F.col("text")))
    return joined.where(F.col(hits).isNull() | (share * hit_words(F.col(hits)) < n_words)).select(*names)


def item_digest(item_ids: Column) -> Column:
    return hex_digest(F.array_join(item_ids, ","))

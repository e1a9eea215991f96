"""Token ids of documents in files: frequency-ranked ids in bytes of variable number.

The documents are sorted by doc_id into shards (range partitions) and encoded once; the ids are kept in the shared
folder as they are, while they are counted. The most frequent id gets rank 0. Each shard is then written as
Parquet rows of one block each: per rank as many data bytes as it needs (one to four), and apart from them the control
bytes, two bits a rank. A block holds whole documents, up to BLOCK_IDS ids or one document. Reading back, a table over the
256 control bytes says which of the 16 bytes of four ranks are there; one masked assignment fills them in, and
the table of ranks, which is stored with the files, gives the ids.

White space never stands inside a token of this vocabulary, nor does a piece go on from an ASCII letter to punctuation
or back, so a text's ids are those of its parts. A task hands the library each part once (at most KNOWN of them are kept,
then it starts anew) and gathers the ids of texts in slices of SLICE_BYTES, so memory grows with the longest text only.
Parts of plain letters need no normalising beyond lower case and no splitting: they go to the library's model at once.

Defined results: a NULL text counts as empty, and an empty text has the end id alone; doc_id may be NULL (first) or repeated
(then by a hash of the text, so that reruns agree); repeated rows are documents of their own; other columns
are not looked at; an empty table gives files without blocks and no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
from partflow.llm.common import text_tag
from partflow.session import scratch_path
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

VOCABULARY, END = "word_bpe_49k.json", 1
#: Parts of texts whose ids a task keeps, some 200 bytes each.
KNOWN = 500_000
SLICE_BYTES, BLOCK_IDS = 4_000_000, 1_000_000
#: A shard has about SHARD_BYTES of text; beyond MAX_SHARDS shards grow instead.
SHARD_BYTES, MAX_SHARDS = 16_000_000, 20_000
#: Where a letter and punctuation meet. Apostrophes may begin a piece with letters, and bars belong to special strings.
LETTER_SIGN, SIGN_LETTER = r"([A-Za-z])([!-/:-@\[-`{}~])", r"([!-&(-/:-@\[-`{}~])([A-Za-z])"
#: Letters below U+0250 that are composed and have one lower-case letter each.
PLAIN = "^[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u0148\u014a-\u017f]+$"
# How byte-level vocabularies spell bytes: printable ones as themselves, the others by 256 and on.
OWN = {*range(33, 127), *range(161, 173), *range(174, 256)}
SPELLED = {byte: chr(256 + nth) for nth, byte in enumerate(byte for byte in range(256) if byte not in OWN)}


class WordEncoder:
    """Ids of texts under one vocabulary file, each distinct part encoded once."""

    def __init__(self, path: str, known: int = KNOWN) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        self.known = known
        self.clear()

    def clear(self) -> None:
        self.places: dict[str, int] = {}
        self.first, self.count = np.zeros(0, np.int32), np.zeros(0, np.int32)
        self.table = np.zeros(0, np.int32)

    def ids_of(self, parts: pa.Array) -> list[list[int]]:
        """The library's ids of every part."""
        plain = pc.match_substring_regex(parts, PLAIN)
        found: list = [None] * len(parts)
        letters = pc.utf8_lower(parts.filter(plain)).to_pylist()
        plain = plain.to_numpy(zero_copy_only=False)
        tokenize = self.model.tokenize
        for place, word in zip(np.flatnonzero(plain).tolist(), letters, strict=True):
            if not word.isascii():
                word = word.encode().decode("latin-1").translate(SPELLED)
            found[place] = [token.id for token in tokenize(word)]
        others = np.flatnonzero(~plain)
        encoded = self.tokenizer.encode_batch_fast(parts.take(pa.array(others)).to_pylist(), add_special_tokens=False)
        for place, encoding in zip(others.tolist(), encoded, strict=True):
            found[place] = encoding.ids
        return found

    def look_up(self, parts: pa.Array) -> np.ndarray:
        """Places of distinct parts in ``first`` and ``count``."""
        if len(self.places) > self.known:
            self.clear()
        listed, places = parts.to_pylist(), self.places
        at = np.fromiter((places.get(part, -1) for part in listed), np.int64, len(listed))
        missing = np.flatnonzero(at < 0)
        if len(missing):
            found = self.ids_of(parts.take(pa.array(missing)))
            count = np.fromiter(map(len, found), np.int32, len(found))
            at[missing] = np.arange(len(self.first), len(self.first) + len(missing))
            places.update((listed[place], where) for place, where in zip(missing.tolist(), at[missing].tolist(), strict=True))
            self.first = np.append(self.first, len(self.table) + np.cumsum(count, dtype=np.int32) - count)
            self.count = np.append(self.count, count)
            self.table = np.append(self.table, np.fromiter(chain.from_iterable(found), np.int32, int(count.sum())))
        return at

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one text after the other, and the number of ids of each."""
        parted = pc.replace_substring_regex(pc.replace_substring_regex(pc.fill_null(texts, ""), LETTER_SIGN, r"\1 \2"), SIGN_LETTER, r"\1 \2")
        words = pc.ascii_split_whitespace(parted)
        coded = words.flatten().dictionary_encode()
        places = self.look_up(coded.dictionary)[coded.indices.to_numpy(zero_copy_only=False)]
        first, count = self.first[places], self.count[places]
        ends = np.cumsum(count, dtype=np.int64)
        total = int(ends[-1]) if len(ends) else 0
        # Steps of one within a part, and to the next part's first id between them.
        steps = np.ones(total, np.int32)
        there = np.flatnonzero(count)
        heads = ends[there] - count[there]
        steps[heads] = np.diff(first[there], prepend=0) - np.append(0, count[there][:-1]) + (np.arange(len(there)) > 0)
        ids = self.table[np.cumsum(steps, dtype=np.int32)] if total else np.zeros(0, np.int32)
        upto = np.append(0, ends)[words.offsets.to_numpy() - words.offsets[0].as_py()]
        return ids, np.diff(upto)


@cache
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def slices(batch: pa.RecordBatch, text: int, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive rows with about ``most`` bytes of text, one row at least."""
    upto = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(batch):
        before = upto[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(upto, before + most, side="right")))
        yield batch.slice(at, end - at)
        at = end


def pack(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes; filled up with rank 0 to a multiple of four."""
    full = np.zeros(-(-len(ranks) // 4) * 4, "<u4")
    full[:len(ranks)] = ranks
    more = (full > 0xFF).astype(np.uint8) + (full > 0xFFFF) + (full > 0xFFFFFF)
    there = np.arange(4) <= more[:, None]
    control = more.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)
    return np.bitwise_or.reduce(control, axis=1).astype(np.uint8).tobytes(), full.view(np.uint8).reshape(-1, 4)[there].tobytes()


#: For each control byte, which of the 16 bytes of its four ranks are stored.
STORED = (np.arange(4) <= (np.arange(256)[:, None, None] >> np.array([0, 2, 4, 6])[:, None] & 3)).reshape(256, 16)


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The first ``n`` ranks."""
    there = STORED[np.frombuffer(control, np.uint8)]
    out = np.zeros(there.shape, np.uint8)
    out[there] = np.frombuffer(data, np.uint8)
    return out.reshape(-1).view("<u4")[:n]


def raw_blocks(docs: DataFrame, path: str, end: int, shard_bytes: int, block_ids: int) -> DataFrame:
    """Blocks of ids in ascending doc_id: shard, block, first (ids of the shard before it), doc_ids, n_ids, ids."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = min(max(1, -(-size // shard_bytes)), MAX_SHARDS)
    keys = ["doc_id", "tag", "row"]
    ordered = docs.select("doc_id", text_tag(F.col("text")).alias("tag"), F.monotonically_increasing_id().alias("row"), "text")
    ordered = ordered.repartitionByRange(shards, *keys).sortWithinPartitions(*keys).select("doc_id", "text")
    kind = pa.uint16() if Tokenizer.from_file(path).get_vocab_size() <= 2 ** 16 else pa.uint32()
    schema = T.StructType([
        T.StructField("shard", T.IntegerType()), T.StructField("block", T.IntegerType()), T.StructField("first", T.LongType()),
        T.StructField("doc_ids", T.ArrayType(docs.schema["doc_id"].dataType)), T.StructField("n_ids", T.ArrayType(T.LongType())),
        T.StructField("width", T.IntegerType()), T.StructField("ids", T.BinaryType())])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, shard, block, first = encoder(path), TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            for part in slices(batch, 1):
                ids, count = words.encode(part.column(1))
                ids = np.insert(ids.astype(kind.to_pandas_dtype()), np.cumsum(count), end)
                count = count + 1
                upto = np.append(0, np.cumsum(count))
                at = 0
                while at < len(count):
                    to = max(at + 1, int(np.searchsorted(upto, upto[at] + block_ids, side="right")) - 1)
                    yield pa.RecordBatch.from_arrays([
                        pa.array([shard], pa.int32()), pa.array([block], pa.int32()), pa.array([first], pa.int64()),
                        pa.ListArray.from_arrays(pa.array([0, to - at], pa.int32()), part.column(0).slice(at, to - at)),
                        pa.array([count[at:to]], pa.list_(pa.int64())), pa.array([kind.bit_width // 8], pa.int32()),
                        pa.array([ids[upto[at]:upto[to]].tobytes()], pa.binary())], schema.names)
                    block, first, at = block + 1, first + int(upto[to] - upto[at]), to

    return ordered.mapInArrow(write, schema)


def ids_in(raw: pa.RecordBatch, row: int) -> np.ndarray:
    return np.frombuffer(raw.column("ids")[row].as_buffer(), f"<u{raw.column('width')[row].as_py()}")


def count_ids(raw: DataFrame) -> DataFrame:
    """id, n: how often every id occurs, the end of every document included."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for row in range(len(batch)):
                found = np.bincount(ids_in(batch, row), minlength=len(total))
                found[:len(total)] += total
                total = found
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen], pa.int64())], ["id", "n"])

    return raw.select("width", "ids").mapInArrow(scan, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def write_tokens(docs: DataFrame, folder: str, vocabulary: str = VOCABULARY, end: int = END, path: str | None = None,
                 shard_bytes: int = SHARD_BYTES, block_ids: int = BLOCK_IDS) -> None:
    """Writes ``folder/ranks`` (rank, id, n) and ``folder/blocks``. ``path`` names another copy of the vocabulary file."""
    spark = docs.sparkSession
    kept = scratch_path(spark, "token-ids")
    blocks = raw_blocks(docs, path or public_tokenizers.path(vocabulary), end, shard_bytes, block_ids)
    blocks.write.option("compression", "zstd").parquet(kept)
    raw = spark.read.schema(blocks.schema).parquet(kept)
    # No more rows than the vocabulary has ids.
    found = sorted((-row.n, row.id) for row in count_ids(raw).collect())
    spark.createDataFrame([(rank, i, -n) for rank, (n, i) in enumerate(found)], "rank long, id long, n long").coalesce(1).write.parquet(
        f"{folder}/ranks")
    rank_of = np.zeros(max((i for _, i in found), default=0) + 1, np.uint32)
    rank_of[[i for _, i in found]] = np.arange(len(found))
    schema = T.StructType([*blocks.schema.fields[:5], T.StructField("control", T.BinaryType()), T.StructField("data", T.BinaryType())])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(len(batch)):
                packed = pack(rank_of[ids_in(batch, row)])
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(k).slice(row, 1) for k in range(5)), *(pa.array([part], pa.binary()) for part in packed)], schema.names)

    raw.mapInArrow(write, schema).write.option("compression", "zstd").parquet(f"{folder}/blocks")


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids (little-endian unsigned 32 bits) from the files."""
    blocks = spark.read.parquet(f"{folder}/blocks")
    # No more rows than the vocabulary has ids.
    ranked = spark.read.parquet(f"{folder}/ranks").orderBy("rank").toPandas()["id"].to_numpy().astype("<u4")
    totals = blocks.groupBy("shard").agg(F.sum(F.aggregate("n_ids", F.lit(0).cast("long"), lambda a, b: a + b)).alias("n"))
    # One row per shard, of which there are MAX_SHARDS at most.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    placed = blocks.join(F.broadcast(offsets), "shard").select(
        (F.col("before") + F.col("first")).alias("start"), "doc_ids", "n_ids", "control", "data")
    schema = T.StructType([
        T.StructField("doc_id", blocks.schema["doc_ids"].dataType.elementType), T.StructField("start", T.LongType()),
        T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(len(batch)):
                start, doc_ids, n_ids, control, data = (batch.column(k)[row] for k in range(5))
                count = n_ids.values.to_numpy()
                upto = np.append(0, np.cumsum(count))
                ids = ranked[unpack(control.as_buffer(), data.as_buffer(), int(upto[-1]))]
                yield pa.RecordBatch.from_arrays([
                    doc_ids.values, pa.array(start.as_py() + upto[:-1], pa.int64()), pa.array(count, pa.int64()),
                    pa.Array.from_buffers(pa.binary(), len(count), [
                        None, pa.py_buffer((4 * upto).astype(np.int32)), pa.py_buffer(ids.astype("<u4"))])], schema.names)

    return placed.mapInArrow(read, schema)


def digest_tokens(docs: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, read back from files in the shared folder."""
    folder = scratch_path(docs.sparkSession, "tokens")
    write_tokens(docs, folder)
    read = read_tokens(docs.sparkSession, folder)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))

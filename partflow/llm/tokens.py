"""Token counts from counts per distinct pre-token.

A text is cut at special strings, normalised and split into pre-tokens; a document's frequencies of
pre-tokens are joined to the number of pieces of each distinct pre-token and summed. The tokenizer sees a
pre-token once: a task keeps the piece counts of the pre-tokens it has met (at most KNOWN of them, then it
starts anew) and no list of ids of a text is ever made. The join stays within the task, since moving
the frequencies of every document through a shuffle would write more than twice the input.

The normaliser of this vocabulary composes, folds white space and lower-cases, and splits by Unicode
classes. Texts below U+0250 without information separators take compiled patterns that give the same
pre-tokens there; all others go through the library's own normaliser and splitter.

Defined results: NULL counts as empty, and an empty text has no tokens; texts are read whole; repeated rows
are rows of their own; other columns are not looked at.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import cache
from operator import mul

import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

VOCABULARY, LIMIT = "word_bpe_49k.json", 2048
#: Piece counts kept by a task, about 100 bytes each.
KNOWN = 1_000_000
#: Outside this range patterns and library might differ.
UNCOMMON = re.compile("[\x1c-\x1fɐ-\U0010ffff]")
# The vocabulary's own split, spelled for the range above, where ²³¹¼½¾ are numbers and no digits.
PRE_TOKEN = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[^\\W\\d_²³¹¼½¾]+|[\\d²³¹¼½¾]|(?:[^\\w\\s]|_)+")


class PieceCounter:
    """Tokens of texts under one vocabulary file."""

    def __init__(self, path: str, known: int = KNOWN) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        special = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.pieces: dict[str, int] = {}
        self.known = known

    def pre_tokens(self, text: str) -> list[str]:
        if not UNCOMMON.search(text):
            return PRE_TOKEN.findall(text.lower())
        normal = self.tokenizer.normalizer.normalize_str(text)
        # The splitter spells pre-tokens in byte letters; its offsets give them back.
        return [normal[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(normal)]

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        parts = self.special.split(text) if self.special else [text]
        frequencies = Counter(token for part in parts for token in self.pre_tokens(part)) if len(parts) > 1 else Counter(
            self.pre_tokens(text))
        if missing := [token for token in frequencies if token not in self.pieces]:
            if len(self.pieces) + len(missing) > self.known:
                self.pieces.clear()
                missing = list(frequencies)
            encoded = self.tokenizer.encode_batch(missing, add_special_tokens=False)
            self.pieces.update(zip(missing, map(len, encoded), strict=True))
        return len(parts) - 1 + sum(map(mul, frequencies.values(), map(self.pieces.__getitem__, frequencies)))


@cache
def counter(path: str) -> PieceCounter:
    return PieceCounter(path)


def count_tokens(docs: DataFrame, vocabulary: str = VOCABULARY, limit: int = LIMIT, path: str | None = None) -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes, n_tokens, over_limit. ``path`` names another copy of the file."""
    rows = docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), "text")
    schema = T.StructType([*rows.schema.fields[:-1], T.StructField("n_tokens", T.LongType())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = counter(path or public_tokenizers.path(vocabulary))
        for batch in batches:
            tokens = pa.array([counts.count(text) for text in batch.column(2).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), tokens], schema.names)

    counted = rows.mapInArrow(scan, schema)
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)

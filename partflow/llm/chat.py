"""Chat formatting by columnar byte assembly.

The turns of an Arrow batch become segments: a header, the escaped text, a footer. Numpy works out their
lengths, the offsets they start at and the place of every byte, and headers and contents are scattered
into one preallocated buffer that is the data of the Arrow column. Rows are dealt by conversation and
sorted by turn; a conversation that a batch cuts waits for the next one.

Control strings start with ``[`` or ``<``, and within texts each of these is followed by a backslash, so
that no control string stands in a text; removing that one character gives the text back.

Defined results: NULL text is empty; a NULL role reads back as an empty one; rows without conv_id are one
conversation; turns go by turn (NULL first), then role, then text, and repeated rows are turns of their
own; an empty text gives an empty turn; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

HEADERS = {"system": ("<<SYS>>\n", "<</SYS>>"), "user": ("<s>[INST] ", "[/INST]"), "assistant": (" ", "</s>")}
OTHER = ("<s>[ROLE]", "[:] ", "[/ROLE]")
MASKED = "assistant"
#: Bytes of text put together at a time, whole conversations; a longer one is put together alone.
CHUNK = 4_000_000

INSIDE = r"((?:[^\[<]|[\[<]\\)*+)"
SEGMENT = re.compile("|".join(re.escape(head) + INSIDE + re.escape(foot) for head, foot in HEADERS.values())
                     + "|" + re.escape(OTHER[0]) + INSIDE + re.escape(OTHER[1]) + INSIDE + re.escape(OTHER[2]))
ROLES = list(HEADERS)


def escape(text: str) -> str:
    return re.sub(r"([\[<])", r"\1\\", text)


def unescape(text: str) -> str:
    return re.sub(r"([\[<])\\", r"\1", text)


def marks_of(role: str) -> tuple[bytes, bytes]:
    head, foot = HEADERS.get(role) or (OTHER[0] + escape(role) + OTHER[1], OTHER[2])
    return head.encode(), foot.encode()


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets from 0 and data of a text column without NULL."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset: column.offset + len(column) + 1]
    data = column.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)
    return offsets - offsets[0], whole[offsets[0]: offsets[-1]]


def within(lengths: np.ndarray) -> np.ndarray:
    """0, 1, ... anew for every length."""
    return np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)


def assemble(roles: list[str], texts: pa.Array, first_rows: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """Formatted conversations, and in each the spans (code points) of the texts to learn from.

    ``first_rows`` are the rows at which conversations start.
    """
    offsets, data = bytes_of(texts)
    lengths = np.diff(offsets)
    opening = (data == ord("[")) | (data == ord("<"))
    before = np.concatenate(([0], np.cumsum(opening)))
    escaped = lengths + before[offsets[1:]] - before[offsets[:-1]]
    kinds, kind_of = np.unique(np.array(roles, dtype=object).astype(str), return_inverse=True)
    marks = [marks_of(str(kind)) for kind in kinds]
    heads = np.array([len(head) for head, _ in marks])[kind_of]
    feet = np.array([len(foot) for _, foot in marks])[kind_of]
    ends = np.cumsum(heads + escaped + feet)
    starts = ends - heads - escaped - feet
    buffer = pa.allocate_buffer(int(ends[-1]))
    out = np.frombuffer(buffer, np.uint8)
    out.flags.writeable or out.setflags(write=True)
    for kind, (head, foot) in enumerate(marks):
        rows = np.flatnonzero(kind_of == kind)
        out[starts[rows][:, None] + np.arange(len(head))] = np.frombuffer(head, np.uint8)
        out[(ends - feet)[rows][:, None] + np.arange(len(foot))] = np.frombuffer(foot, np.uint8)
    # A byte moves on by the escapes before it in its own text.
    place = np.repeat(starts + heads - before[offsets[:-1]], lengths) + within(lengths) + before[:-1]
    out[place] = data
    out[place[opening] + 1] = ord("\\")
    conversation_offsets = np.concatenate((starts[first_rows], ends[-1:]))
    formatted = pa.LargeStringArray.from_buffers(len(first_rows), pa.py_buffer(conversation_offsets.astype(np.int64)), buffer)
    # Code points before each byte.
    points = np.concatenate(([0], np.cumsum((out & 0xC0) != 0x80)))
    learned = np.flatnonzero(np.array([kind == MASKED for kind in kinds])[kind_of])
    owner = np.searchsorted(first_rows, learned, side="right") - 1
    base = points[starts[first_rows]][owner]
    spans = pa.StructArray.from_arrays([
        pa.array(points[(starts + heads)[learned]] - base, pa.int64()),
        pa.array(points[(ends - feet)[learned]] - base, pa.int64())], ["start", "end"])
    list_offsets = np.searchsorted(owner, np.arange(len(first_rows) + 1))
    return formatted, pa.ListArray.from_arrays(pa.array(list_offsets, pa.int32()), spans)


def conversations_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Whole conversations with the rows they start at, a bounded number of bytes at a time."""
    waiting: list[pa.RecordBatch] = []
    last = None

    def ready(parts: list[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
        table = pa.Table.from_batches(parts).combine_chunks()
        keys = table.column(0).to_pylist()
        firsts = [row for row, key in enumerate(keys) if not row or key != keys[row - 1]]
        size = np.diff(bytes_of(table.column("text").combine_chunks().cast(pa.large_string()).fill_null(""))[0])
        total = np.concatenate(([0], np.cumsum(size)))
        begin = 0
        for nth in range(1, len(firsts) + 1):
            at = firsts[nth] if nth < len(firsts) else len(keys)
            if nth == len(firsts) or total[firsts[nth + 1] if nth + 1 < len(firsts) else -1] - total[firsts[begin]] > CHUNK:
                yield table.slice(firsts[begin], at - firsts[begin]), np.array(firsts[begin:nth]) - firsts[begin]
                begin = nth

    for batch in batches:
        keys = batch.column(0).to_pylist()
        if not keys:
            continue
        if waiting and keys[-1] == last == keys[0]:
            waiting.append(batch)
            continue
        cut = next(row for row in range(len(keys) - 1, -1, -1) if not row or keys[row - 1] != keys[row])
        if cut or waiting:
            if parts := [*waiting, batch.slice(0, cut)] if cut else waiting:
                yield from ready(parts)
        waiting, last = [batch.slice(cut)], keys[-1]
    if waiting:
        yield from ready(waiting)


def format_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table, first_rows in conversations_of(batches):
        texts = table.column("text").combine_chunks().cast(pa.large_string()).fill_null("")
        roles = [role or "" for role in table.column("role").to_pylist()]
        formatted, loss = assemble(roles, texts, first_rows)
        yield pa.RecordBatch.from_arrays(
            [table.column(0).combine_chunks().take(pa.array(first_rows)), formatted.cast(pa.string()), loss],
            ["conv_id", "formatted", "loss"])


def format_chats(conversations: DataFrame) -> DataFrame:
    """conv_id, formatted (text) and loss (spans of the text to learn from) per conversation."""
    rows = conversations.select("conv_id", "turn", "role", "text")
    schema = T.StructType([rows.schema["conv_id"], T.StructField("formatted", T.StringType()), T.StructField(
        "loss", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])))])
    dealt = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return dealt.mapInArrow(format_batches, schema)


def read_back(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of every turn."""
    turns, at = [], 0
    while at < len(formatted):
        found = SEGMENT.match(formatted, at)
        if not found or found.end() == at:
            raise ValueError(f"no turn at {at}")
        if found.lastindex <= len(ROLES):
            turns.append((ROLES[found.lastindex - 1], unescape(found.group(found.lastindex))))
        else:
            turns.append((unescape(found.group(len(ROLES) + 1)), unescape(found.group(len(ROLES) + 2))))
        at = found.end()
    return turns


def with_probe(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    """The table and conversation -7, whose texts are control strings."""
    probe = "</s>[INST] ok [/INST]"
    rows = spark.createDataFrame([(-7, 0, "user", probe), (-7, 1, "assistant", probe)],
                                 "conv_id long, turn long, role string, text string")
    return conversations.select("conv_id", "turn", "role", "text").unionByName(rows)


def digest_chats(chats: DataFrame) -> DataFrame:
    """What reads back from formatted conversations: turns, digests of turns and of the text to learn from."""
    from hashlib import sha256

    schema = T.StructType([chats.schema["conv_id"], *[T.StructField(name, kind) for name, kind in (
        ("n_turns", T.LongType()), ("turns_sha256", T.StringType()), ("loss_chars", T.LongType()),
        ("loss_sha256", T.StringType()), ("formatted_chars", T.LongType()))]])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, loss in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                turns = read_back(text)
                learned = "".join(unescape(text[span["start"]: span["end"]]) for span in loss)
                spelled = "".join(f"{role}\n{said}\n" for role, said in turns)
                rows.append((len(turns), sha256(spelled.encode()).hexdigest(), len(learned),
                             sha256(learned.encode()).hexdigest(), len(text)))
            columns = list(zip(*rows, strict=True)) or [()] * 5
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(column, kind) for column, kind in zip(columns, kinds, strict=True)]], schema.names)

    return chats.select("conv_id", "formatted", "loss").mapInArrow(read, schema)

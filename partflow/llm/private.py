"""Personal data by anchor expansion: one Aho-Corasick pass finds anchors, local parsers expand them.

Anchors are at-signs, a plus before a digit, a digit on both sides of a point (IP addresses) or beside
another digit (cards), scheme marks and identifier cues. Each anchor is expanded to the left and right by a
parser of its kind and validated. Work is per text, in Arrow batches; nothing is shuffled.

Base kinds, in order: email, ip, card, phone; leftmost, non-overlapping per kind; what fails its check is
dropped and not tried again. Added kinds: iban (cue, then a number that passes its checksum), ssn (cue),
account (cue, then 6 to 17 digits) and login (user and password within an address). Offsets are code points, ends exclusive.

Defined results: NULL counts as empty, an empty text has no spans; texts are read whole; rows that repeat
are rows of their own; ``redact`` keeps all columns of ``docs``, NULL texts stay NULL.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache
from hashlib import sha256

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "ssn", "account", "login")
RANK = {kind: place for place, kind in enumerate(KINDS)}

LOCAL_PART = re.compile(r"[A-Za-z0-9._%+-]*\Z")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DIGIT_RUN = re.compile(r"[0-9]*\Z")
ADDRESS = re.compile(r"[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
IBAN = re.compile(r"[:#\s]{0,4}([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30})(?![A-Za-z0-9])")
SSN = re.compile(r"[:#\s]{0,4}([0-9]{3}-[0-9]{2}-[0-9]{4})(?![0-9])")
ACCOUNT = re.compile(r"(?: (?:number|no\.?))?[:#\s]{0,4}([0-9]{6,17})(?![0-9])")
LOGIN = re.compile(r"([^\s/@:]{1,256}:[^\s/@]{1,256})@")
#: How far to the left a run is looked for at a time.
REACH = 64


@cache
def automaton() -> ahocorasick.Automaton:
    """Anchor strings to (kind, length)."""
    found = ahocorasick.Automaton()
    digits = "0123456789"
    anchors = {"@": "email", "://": "login"}
    anchors |= {f"+{a}": "phone" for a in digits}
    anchors |= {f"{a}.{b}": "ip" for a in digits for b in digits}
    anchors |= {f"{a}{between}{b}": "card" for a in digits for b in digits for between in ("", " ", "-")}
    for kind, cues in (("iban", ("IBAN", "iban")), ("ssn", ("SSN", "ssn", "social security number")),
                       ("account", ("account", "Account", "acct", "Acct"))):
        anchors |= {cue: kind for cue in cues}
    for anchor, kind in anchors.items():
        found.add_word(anchor, (kind, len(anchor)))
    found.make_automaton()
    return found


def run_start(text: str, end: int, floor: int, run: re.Pattern) -> int:
    """Where the run of characters that ends before ``end`` starts, not before ``floor``."""
    start = end
    while start > floor:
        low = max(floor, start - REACH)
        begin = low + run.search(text[low:start]).start()
        if begin == start:
            break
        start = begin
        if start > low:
            break
    return start


def passes_luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def passes_iban(number: str) -> bool:
    turned = number[4:] + number[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def find_email(text: str, at: int, floor: int) -> tuple[int, int, bool] | None:
    start = run_start(text, at, floor, LOCAL_PART)
    domain = DOMAIN.match(text, at) if start < at else None
    return (start, domain.end(), True) if domain else None


def find_ip(text: str, at: int, floor: int) -> tuple[int, int, bool] | None:
    start = run_start(text, at + 1, floor, DIGIT_RUN)
    found = ADDRESS.match(text, start) if start <= at else None
    if not found:
        return None
    parts = (part.lstrip("0") for part in found.group().split("."))
    return start, found.end(), all(len(part) <= 3 and int(part or 0) <= 255 for part in parts)


def find_card(text: str, at: int, floor: int) -> tuple[int, int, bool] | None:
    found = CARD.match(text, max(at, floor))
    if not found:
        return None
    digits = re.sub("[ -]", "", found.group())
    return found.start(), found.end(), 12 <= len(digits) <= 19 and passes_luhn(digits)


def find_phone(text: str, at: int, floor: int) -> tuple[int, int, bool] | None:
    found = PHONE.match(text, at)
    return found and (at, found.end(), 9 <= sum(map(str.isdecimal, found.group())) <= 15)


def after_cue(pattern: re.Pattern, check=lambda value: True):
    def find(text: str, at: int, floor: int) -> tuple[int, int, bool] | None:
        found = pattern.match(text, at)
        return found and (found.start(1), found.end(1), check(found.group(1).replace(" ", "")))
    return find


PARSERS = {"email": find_email, "ip": find_ip, "card": find_card, "phone": find_phone,
           "iban": after_cue(IBAN, passes_iban), "ssn": after_cue(SSN), "account": after_cue(ACCOUNT),
           "login": after_cue(LOGIN)}
#: These are read from the end of their anchor, the others from its start.
AFTER = ("iban", "ssn", "account", "login")


def spans_of(text: str | None) -> list[tuple[int, int, str]]:
    """(start, end, kind) by start, then kind."""
    done = dict.fromkeys(KINDS, 0)
    spans = []
    for last, (kind, length) in automaton().iter(text or ""):
        at = last + 1 if kind in AFTER else last + 1 - length
        if at < done[kind] and kind != "ip":
            continue
        found = PARSERS[kind](text, at, done[kind])
        if found:
            start, end, valid = found
            done[kind] = end
            if valid:
                spans.append((start, end, kind))
    return sorted(spans, key=lambda span: (span[0], RANK[span[2]], span[1]))


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def find_private(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, the count of each base kind, base_sha256, spans (text form) of all kinds."""
    counted = [T.StructField(f"n_{kind}", T.LongType()) for kind in BASE_KINDS]
    schema = T.StructType([docs.select("doc_id").schema["doc_id"], *counted,
                           T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [spans_of(text) for text in batch.column(1).to_pylist()]
            counts = [pa.array([sum(span[2] == kind for span in spans) for spans in found], pa.int64())
                      for kind in BASE_KINDS]
            base = [[span for span in spans if span[2] in BASE_KINDS] for spans in found]
            digests = pa.array([sha256(joined(spans).encode()).hexdigest() for spans in base], pa.string())
            texts = pa.array([joined(spans) for spans in found], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), *counts, digests, texts], schema.names)

    return docs.select("doc_id", "text").mapInArrow(scan, schema)


def masked(text: str | None) -> str | None:
    """The text with a mark of the kind in place of each span; overlapping spans become one mark."""
    if not text:
        return text
    parts, done = [], 0
    for start, end, kind in spans_of(text):
        if start >= done:
            parts += [text[done:start], f"[{kind.upper()}]"]
        done = max(done, end)
    return "".join([*parts, text[done:]])


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with marks in place of personal data."""
    place = docs.columns.index("text")

    def change(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([masked(text) for text in batch.column(place).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:place], texts, *batch.columns[place + 1:]], batch.schema.names)

    return docs.mapInArrow(change, docs.schema)

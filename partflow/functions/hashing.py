"""Row fingerprints."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Separator and NULL mark of the joined form.
SEPARATOR = "||"
NULL_MARK = "<NULL>"


def json_of(columns: Sequence[str]) -> Column:
    return F.to_json(F.struct(*[F.col(c) for c in columns]), {"ignoreNullFields": "false"})


def payload_hash(columns: Sequence[str]) -> Column:
    """SHA-256 of the JSON object of the columns, NULLs included."""
    return F.sha2(json_of(columns), 256)


def row_hash(columns: Sequence[str], form: str = "joined") -> Column:
    """SHA-256 over the columns.

    ``joined`` keeps the hashes of existing histories; texts that hold the separator
    can collide there, which ``json`` rules out.
    """
    if form == "json":
        return payload_hash(columns)
    marked = [F.coalesce(F.col(c).cast("string"), F.lit(NULL_MARK)) for c in columns]
    return F.sha2(F.concat_ws(SEPARATOR, *marked), 256)

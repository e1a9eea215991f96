"""Projections, filters and row windows."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from partflow.config import AUDIT_COLUMNS, LINEAGE_COLUMNS
from partflow.functions.codes import blank_to_null, is_blank
from partflow.functions.dates import shift_month
from partflow.functions.names import normalized_names
from partflow.functions.numbers import try_cast


def normalize_columns(df: DataFrame, rename: Mapping[str, str] | None = None) -> DataFrame:
    return df.toDF(*normalized_names(df.columns, rename))


def promote_header(df: DataFrame, header: Sequence[str], probe: int = 3) -> DataFrame:
    """Names the columns from a known header and drops every row that repeats it."""
    named = df.toDF(*normalized_names(header))
    repeats = F.lit(True)
    for name, title in list(zip(named.columns, header))[:probe]:
        repeats = repeats & F.col(name).eqNullSafe(F.lit(title))
    return named.where(~repeats)


def line_pattern(layout: Sequence[str], header_mark: str, date_field: str) -> str:
    """Shape of a usable line: every field in place, no header, a date in the date field.

    One bar before the first and one after the last field belong to the report's frame;
    a line that ends in a bar is always taken to have that frame.
    """
    fields = ["[^|]*"] * len(layout)
    fields[layout.index(date_field)] = r" *\d{2}\.\d{2}\.\d{4} *"
    return rf"^\|?+(?!{re.escape(header_mark)})" + r"\|".join(fields) + r"(?:\||(?<!\|))$"


def parse_delimited(
    lines: DataFrame,
    layout: Sequence[str],
    line: str = "value",
    header_mark: str = "Doc.",
    date_field: str = "data",
) -> DataFrame:
    """Splits ``|``-delimited lines into trimmed fields.

    Blank lines, lines with another number of fields, headers and lines whose date field
    has no date shape are left out: one pattern decides before anything is split. Other
    columns of the input are kept.
    """
    kept = [c for c in lines.columns if c != line]
    usable = lines.where(F.col(line).rlike(line_pattern(layout, header_mark, date_field)))
    bare = F.regexp_replace(F.col(line), r"^\||\|$", "")
    fields = usable.select(*kept, F.split(bare, r"\|").alias("_f"))
    return fields.select(
        *kept, *[F.trim(F.get(F.col("_f"), F.lit(i))).alias(n) for i, n in enumerate(layout)])


def blanks_to_null(df: DataFrame) -> DataFrame:
    """Blank texts become NULL in every text column."""
    return df.select(*[
        blank_to_null(F.col(f"`{f.name}`")).alias(f.name)
        if isinstance(f.dataType, StringType) else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])


def apply_mapping(df: DataFrame, mapping: Mapping[str, tuple[str, str | None]]) -> DataFrame:
    """Selects ``{source: (name, type)}``; without a type the column keeps its own."""
    return df.select(*[
        (F.col(f"`{c}`").cast(t) if t else F.col(f"`{c}`")).alias(n)
        for c, (n, t) in mapping.items()
    ])


def try_types(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Casts the listed columns; a value that does not convert becomes NULL."""
    return df.select(*[
        try_cast(F.col(f"`{c}`"), types[c]).alias(c) if c in types else F.col(f"`{c}`")
        for c in df.columns
    ])


def with_audit(df: DataFrame, load_id: str, now: Column, user: str, load_type: str,
               columns: Sequence[str] = AUDIT_COLUMNS) -> DataFrame:
    """Audit columns. ``now`` is passed in, so that one load carries one time."""
    values = {
        "_ingested_at": now, "_last_updated_at": now, "_ingested_by": F.lit(user),
        "_load_type": F.lit(load_type), "_load_id": F.lit(load_id),
    }
    return df.withColumns({c: values[c] for c in columns})


def closed_month_window(df: DataFrame, day: str, months: int, anchor: date | None = None,
                        half_open: bool = False) -> DataFrame:
    """Rows of the last ``months`` months up to the month of the latest row.

    A known ``anchor`` becomes a literal that the scan can push down; otherwise the
    latest day is read once as a scalar subquery.
    """
    if anchor is not None:
        start, end = F.lit(shift_month(anchor, 1 - months)), F.lit(shift_month(anchor, 1))
    else:
        latest = df.select(F.trunc(F.max(day), "month").alias("m"))
        start = latest.select(F.add_months("m", 1 - months)).scalar()
        end = latest.select(F.add_months("m", 1)).scalar()
    kept = df.where(F.col(day) >= start)
    return kept.where(F.col(day) < end) if half_open else kept


def demand_slice(df: DataFrame, org: str | None = None, channel: str | None = None,
                 only_type: str | None = None, exclude_type: str | None = None) -> DataFrame:
    return df.where(slice_condition(org, channel, only_type, exclude_type))


def slice_condition(org: str | None = None, channel: str | None = None,
                    only_type: str | None = None, exclude_type: str | None = None) -> Column:
    """Rows without an order type do not pass ``exclude_type``."""
    tests = [
        org and (F.col("org_vendas") == org),
        channel and (F.col("canal_dist") == channel),
        only_type and (F.col("tipo_ov") == only_type),
        exclude_type and (F.col("tipo_ov") != exclude_type),
    ]
    condition = F.lit(True)
    for test in tests:
        if test is not None:
            condition = condition & test
    return condition


def in_domain(df: DataFrame, column: str, values: Sequence[str], negate: bool = False) -> DataFrame:
    """Rows inside (or outside) a code list; NULL passes neither."""
    inside = F.col(column).isin(*values)
    return df.where(~inside if negate else inside)


def invalid_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    condition = F.lit(False)
    for key in keys:
        condition = condition | is_blank(F.col(key).cast("string"))
    return df.where(condition)


def optional_eq(column: Column, wanted: object | None) -> Column:
    """Equality that an absent parameter switches off."""
    return F.lit(True) if wanted is None else column == F.lit(wanted)


def consumer_view(df: DataFrame, hidden: Sequence[str] = (*AUDIT_COLUMNS, *LINEAGE_COLUMNS),
                  **overrides: Column) -> DataFrame:
    """Business columns in their order, single ones replaced."""
    return df.select(*[
        overrides[c].alias(c) if c in overrides else F.col(f"`{c}`")
        for c in df.columns if c not in hidden
    ])


def order_columns(df: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Fixed columns first, the rest in name order."""
    rest = sorted(c for c in df.columns if c not in ids)
    return df.select(*[F.col(f"`{c}`") for c in (*ids, *rest)])


def head_by(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def latest_cycle(df: DataFrame, day: str) -> DataFrame:
    """The month of the latest row, as a one-row result."""
    return df.agg(F.trunc(F.max(day), "month").alias("ciclo"))

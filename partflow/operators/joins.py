"""Joins. A side is broadcast only while it is small in rows, or by Spark's own measure at run time."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partflow.session import settle

#: Lookups up to this many rows are sent to every executor (a row takes some 200 bytes: 40 MB).
LOOKUP_ROWS = 200_000


def sized_lookup(side: DataFrame) -> DataFrame:
    """The lookup, marked for a broadcast while its rows are few and for a shuffle beyond.

    Spark plans by the size of the files, which are packed, and by the rows before an explode.
    """
    return F.broadcast(side) if side.count() <= LOOKUP_ROWS else side.hint("merge")


def lookup_join(fact: DataFrame, dim: DataFrame, on: Mapping[str, str], how: str = "left",
                counted: bool = True) -> DataFrame:
    """Join a fact to a lookup on ``{fact column: lookup column}``.

    The lookup's key columns are not kept. Only joins led by the fact: ``left`` and ``inner``.
    """
    return lookup_joins(fact, [(dim, on)], how, counted)


def lookup_joins(
    fact: DataFrame,
    lookups: Sequence[tuple[DataFrame, Mapping[str, str]]],
    how: str = "left",
    counted: bool = True,
) -> DataFrame:
    """Several lookups in a row.

    A lookup of at most LOOKUP_ROWS rows is broadcast; beyond it both sides are shuffled, and
    adaptive execution splits the partition of a hot or NULL key (``session.SETTINGS``). A lookup that comes out of
    joins and groups of its own costs as much to count as to make: with ``counted`` off Spark measures it at its
    shuffle. Put a lookup whose keys are part of the next one's keys first: the fact then stays where the first join has put it
    (``spark.sql.requireAllClusterKeysForCoPartition`` off), and only the second lookup moves.
    """
    if how not in ("left", "inner"):
        raise ValueError("a lookup join is left or inner")
    for n, (dim, on) in enumerate(lookups):
        types = dict(dim.dtypes)
        keys = {f"_k{n}_{i}": d for i, d in enumerate(on.values())}
        side = dim.select(
            *[F.col(f"`{d}`").alias(k) for k, d in keys.items()],
            *[F.col(f"`{c}`") for c in dim.columns if c not in on.values()])
        side = sized_lookup(side) if counted else side
        equal = [F.col(f).cast(types[d]) == F.col(k) for (f, d), k in zip(on.items(), keys)]
        fact = fact.join(side, reduce(Column.__and__, equal), how).drop(*keys)
    return fact


def full_merge(left: DataFrame, right: DataFrame, keys: Sequence[str], fill: float = 0) -> DataFrame:
    """Full outer join of two results; numeric gaps are filled."""
    return left.join(right, list(keys), "full").fillna(fill)


def join_on_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join of two aggregates on all their keys."""
    return left.join(right, list(keys))


def unprocessed(raw: DataFrame, done: DataFrame | None, raw_id: str, done_id: str) -> DataFrame:
    """Rows whose load has not been taken over yet."""
    if done is None:
        return raw
    loads = done.select(F.col(done_id).alias("_done")).distinct()
    return raw.join(loads, F.col(raw_id) == F.col("_done"), "left_anti")


def rows_not_in(df: DataFrame, keys_of: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.join(keys_of.select(*keys), list(keys), "left_anti")


def null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Equality on keys of which some may be NULL; the right side has them as ``_key0`` and on."""
    return reduce(Column.__and__, [left[k].eqNullSafe(right[f"_key{n}"]) for n, k in enumerate(keys)])


def null_safe_side(df: DataFrame, keys: Sequence[str], *others: str) -> DataFrame:
    return df.select(*[F.col(k).alias(f"_key{n}") for n, k in enumerate(keys)], *others)


#: Scopes up to this many are sent to every executor (a scope takes some 50 bytes: 5 MB at most).
BROADCAST_SCOPES = 100_000


def scope_rows(scopes: DataFrame) -> DataFrame:
    """Distinct scopes, marked for a broadcast while they are few: the table that holds them need not move."""
    found = settle(scopes.distinct())
    return F.broadcast(found) if found.count() <= BROADCAST_SCOPES else found


def latest_only(df: DataFrame, column: str) -> DataFrame:
    """Rows that hold the greatest value of a column."""
    greatest = df.select(F.max(column).alias("m")).scalar()
    return df.where(F.col(column) == greatest)

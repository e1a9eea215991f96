"""Table changes as functions from old rows and a batch to new rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from partflow.functions.dates import shift_month
from partflow.functions.hashing import row_hash
from partflow.functions.numbers import round_half_even
from partflow.operators.joins import null_safe, null_safe_side, rows_not_in, scope_rows

# Fixed value: start of the first known version.
HISTORY_START = datetime(1900, 1, 1)


def dedupe_latest(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str] = ()) -> DataFrame:
    """One row per key: the greatest by ``order``, then by content.

    Written as a maximum over structs, which combines before the shuffle; a row_number
    window would send all rows of a hot key to one task.
    """
    rest = [c for c in df.columns if c not in keys]
    ranks = [(F.col(o) if isinstance(o, str) else o).alias(f"_o{i}") for i, o in enumerate(order)]
    best = df.groupBy(*keys).agg(
        F.max(F.struct(*ranks, *[F.col(f"`{c}`") for c in rest])).alias("_best"))
    return best.select(*keys, *[F.col(f"_best.`{c}`") for c in rest]).select(
        *[F.col(f"`{c}`") for c in df.columns])


def upsert(old: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Batch rows replace the old rows of their keys. The batch holds one row per key."""
    return rows_not_in(old, batch, keys).unionByName(batch, allowMissingColumns=True)


def replace_scopes(old: DataFrame, batch: DataFrame, scopes: Sequence[str]) -> DataFrame:
    """All rows of the scopes that occur in the batch are replaced; other scopes stay.

    A batch covers few scopes as a rule: they are broadcast, and the old rows stay where they are.
    A scope that is NULL, in whole or in part, is a scope too.
    """
    found = scope_rows(null_safe_side(batch, scopes))
    return old.join(found, null_safe(old, found, scopes), "left_anti").unionByName(batch)


def delete_period(df: DataFrame, day: str, year: int, month: int) -> DataFrame:
    """Rows outside one month; rows without a date stay."""
    start = date(year, month, 1)
    inside = (F.col(day) >= F.lit(start)) & (F.col(day) < F.lit(shift_month(start, 1)))
    return df.where(~F.coalesce(inside, F.lit(False)))


def drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(keys))


def scd2_start(history: DataFrame | None, reference: date) -> datetime:
    """Versions of the first load start at the sentinel, later ones at the reference month."""
    if history is None or history.isEmpty():
        return HISTORY_START
    return datetime(reference.year, reference.month, 1)


def open_versions(stage: DataFrame, start: datetime) -> DataFrame:
    """Adds the validity columns of a new current version."""
    return stage.withColumns({
        "start_date": F.lit(start).cast("timestamp"),
        "end_date": F.lit(None).cast("timestamp"),
        "is_current": F.lit(True),
    })


def scd2_apply(
    history: DataFrame,
    stage: DataFrame,
    keys: Sequence[str],
    reference: date,
    hash_column: str = "row_hash",
    closed_audit: Mapping[str, Column] | None = None,
) -> DataFrame:
    """New state of a type-2 history after one snapshot.

    Closed versions pass through untouched. The current ones meet the snapshot in one
    full outer join: a version ends when its key is missing or its hash differs, and
    the snapshot's row opens a version when its key is new or its hash differs.
    ``closed_audit`` gives the audit values that an ended version takes from this load.
    """
    closed, touched = scd2_changes(history, stage, keys, reference, hash_column, closed_audit)
    return closed.unionByName(touched)


def scd2_changes(
    history: DataFrame,
    stage: DataFrame,
    keys: Sequence[str],
    reference: date,
    hash_column: str = "row_hash",
    closed_audit: Mapping[str, Column] | None = None,
    counted: Observation | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The untouched closed versions, and everything this snapshot keeps, ends or opens.

    ``counted`` gets the numbers of unchanged, changed, missing and added versions once the second has been written.
    """
    columns = history.columns
    end = F.lit(datetime(reference.year, reference.month, 1)).cast("timestamp")
    current = history.where("is_current").select(
        *keys, F.struct(*[F.col(f"`{c}`") for c in columns]).alias("old"))
    rows = stage.select(
        *keys, F.struct(*[F.col(f"`{c}`") for c in columns]).alias("new"))
    met = current.join(rows, list(keys), "full")
    if counted is not None:
        met = met.observe(counted, *version_counts(F.col(f"old.{hash_column}"), F.col(f"new.{hash_column}")))
    same = F.coalesce(F.col(f"old.{hash_column}") == F.col(f"new.{hash_column}"), F.lit(False))
    final = {**(closed_audit or {}), "end_date": end, "is_current": F.lit(False)}
    ended = F.struct(*[final.get(c, F.col(f"old.`{c}`")).alias(c) for c in columns])
    versions = F.array(
        F.when(F.col("old").isNotNull(), F.when(same, F.col("old")).otherwise(ended)),
        F.when(F.col("new").isNotNull() & ~same, F.col("new")),
    )
    touched = met.select(F.explode(F.array_compact(versions)).alias("v")).select("v.*")
    return history.where("NOT is_current"), touched


def version_counts(old: Column, new: Column) -> list[Column]:
    """Counts over pairs of an old and a new hash; a hash is NULL where its side has no row."""
    return [F.count_if(old == new).alias("unchanged"), F.count_if(old != new).alias("changed"),
            F.count_if(new.isNull()).alias("missing"), F.count_if(old.isNull()).alias("added")]


def scd2_counts(history: DataFrame, stage: DataFrame, keys: Sequence[str],
                hash_column: str = "row_hash") -> DataFrame:
    """How many versions one snapshot would keep, change, end and open, in one pass."""
    current = history.where("is_current").select(*keys, F.col(hash_column).alias("_old"))
    rows = stage.select(*keys, F.col(hash_column).alias("_new"))
    return current.join(rows, list(keys), "full").agg(*version_counts(F.col("_old"), F.col("_new")))


def as_of(history: DataFrame, day: date | datetime | Column) -> DataFrame:
    """The versions valid at a point in time."""
    moment = day if isinstance(day, Column) else F.lit(day).cast("timestamp")
    return history.where(
        (F.col("start_date") <= moment)
        & (F.col("end_date").isNull() | (moment < F.col("end_date"))))


def join_versions(facts: DataFrame, history: DataFrame, on: Mapping[str, str], day: str, columns: Sequence[str],
                  unit: str = "year") -> DataFrame:
    """Every fact with the version that was valid on its day; NULL where there was none. ``on`` maps fact to history columns.

    A key's versions are cut at the years (``unit``) of the facts and gathered per key and year, in order of their start; a
    fact meets the one row of its key and year and takes the last version that has started and not ended. So a fact is
    never paired with all versions of its key, the gathered rows stay short, and facts of a hot key, which adaptive
    execution splits, carry one year of versions. Of overlapping versions the later start counts.
    """
    cell = F.trunc(F.col(day), unit)
    low, high = facts.agg(F.min(cell), F.max(cell)).first()
    if low is None:
        return facts.withColumns({c: F.lit(None).cast(history.schema[c].dataType) for c in columns})
    first = F.greatest(F.trunc("start_date", unit), F.lit(low))
    last = F.least(F.trunc(F.coalesce("end_date", F.lit(high).cast("timestamp")), unit), F.lit(high))
    keys = {f"_key{n}": F.col(h) for n, h in enumerate(on.values())}
    step = F.expr("interval 1 year" if unit == "year" else "interval 1 month")
    cut = history.where(first <= last).select(
        *[column.alias(name) for name, column in keys.items()], F.explode(F.sequence(first, last, step)).alias("_cell"),
        F.struct("start_date", "end_date", *columns).alias("_version"))
    gathered = cut.groupBy(*keys, "_cell").agg(F.sort_array(F.collect_list("_version")).alias("_versions"))
    moment = F.col(day).cast("timestamp")
    valid = F.filter("_versions", lambda v: (v["start_date"] <= moment) & (v["end_date"].isNull() | (v["end_date"] > moment)))
    equal = F.col("_cell") == F.trunc(F.col(day), unit)
    for name, fact in zip(keys, on, strict=True):
        equal = equal & (F.col(fact) == F.col(name))
    met = facts.join(gathered, equal, "left").withColumn("_valid", F.try_element_at(valid, F.lit(-1)))
    return met.select(*facts.columns, *[F.col("_valid")[c].alias(c) for c in columns])


def scd2_state(history: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Versions and current versions per key, first and last change."""
    return history.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("versions"),
        F.count_if("is_current").alias("current_versions"),
        F.min("start_date").alias("first_start"),
        F.max("start_date").alias("last_start"),
    )


def backfill_column(
    history: DataFrame,
    stage: DataFrame,
    keys: Sequence[str],
    column: str,
    tracked: Sequence[str],
    hash_column: str = "row_hash",
    audit: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Adds a tracked column to a history without opening new versions.

    Current rows that occur in the snapshot take its value and a recomputed hash; all
    other rows get NULL and keep their hash.
    """
    closed = history.where("NOT is_current").withColumn(column, F.lit(None).cast("string"))
    values = stage.select(*keys, F.col(column), row_hash(tracked).alias("_fresh"),
                          F.lit(True).alias("_hit"))
    current = history.where("is_current").join(values, list(keys), "left")
    hit = F.coalesce(F.col("_hit"), F.lit(False))
    changes = {hash_column: F.when(hit, F.col("_fresh")).otherwise(F.col(hash_column))}
    for name, value in (audit or {}).items():
        changes[name] = F.when(hit, value).otherwise(F.col(name))
    current = current.withColumns(changes).drop("_hit", "_fresh")
    return current.unionByName(closed)


def decimal_migration_checks(df: DataFrame, column: str, precision: int = 18, scale: int = 2,
                             tolerance: float = 1e-4) -> DataFrame:
    """One row: rows, values, values that do not fit, values with more decimals."""
    value = F.col(column)
    target = value.try_cast(f"decimal({precision},{scale})")
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count(value).alias("non_null"),
        F.count_if(value.isNotNull() & target.isNull()).alias("invalid_casts"),
        F.count_if(F.abs(value.cast("double") - F.bround(value.cast("double"), scale)) > tolerance)
        .alias("extra_decimals"),
    )


def migrate_decimal(df: DataFrame, column: str, precision: int = 18, scale: int = 2) -> DataFrame:
    """The column as a decimal, rounded half to even. Run the checks first."""
    return df.withColumn(column, round_half_even(F.col(column), precision, scale))

"""Aggregations. All of them combine on the map side, so hot keys stay cheap."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partflow.functions.dates import label_of, month_start
from partflow.functions.numbers import percent, total_of, trunc_int
from partflow.operators.joins import null_safe, null_safe_side


def sum_by_month(df: DataFrame, keys: Sequence[str], day: str, qty: str,
                 month: str = "mes") -> DataFrame:
    return df.groupBy(*keys, month_start(F.col(day)).alias(month)).agg(F.sum(qty).alias(qty))


def lines_by_month(df: DataFrame, keys: Sequence[str], day: str, qty: str,
                   month: str = "mes", name: str = "linhas") -> DataFrame:
    """Counts the rows that carry a quantity."""
    return df.groupBy(*keys, month_start(F.col(day)).alias(month)).agg(F.count(qty).alias(name))


def pivot_months(df: DataFrame, keys: Sequence[str], months: Sequence[date], value: str,
                 month: str = "mes") -> DataFrame:
    """One integer column per month, 0 where a month has no row.

    The sums are cut to whole numbers per month, before they are spread.
    """
    sums = df.groupBy(*keys, month_start(F.col(month)).alias("_month")).agg(
        trunc_int(F.coalesce(F.sum(value), F.lit(0))).alias("_whole"))
    return spread_months(sums, keys, months, "_whole", "_month")


def spread_months(df: DataFrame, keys: Sequence[str], months: Sequence[date], value: str,
                  month: str = "mes") -> DataFrame:
    """Spreads one row per key and month over one column per month, 0 where there is none.

    The months are given, so no extra job looks for them and every sheet has the same
    columns. One aggregation compares month numbers, which is cheaper than a pivot's
    second pass over wide buffers.
    """
    first = months[0].year * 12 + months[0].month
    number = F.year(month) * 12 + F.month(month) - F.lit(first)
    columns = [(m.year * 12 + m.month - first, label_of(m)) for m in months]
    return df.withColumn("_number", number).groupBy(*keys).agg(*[
        F.expr(f"coalesce(max(if(_number = {n}, `{value}`, NULL)), 0) AS `{name}`")
        for n, name in columns])


def static_pivot(df: DataFrame, keys: Sequence[str], on: str, values: Sequence[str],
                 value: str, fill: object | None = None) -> DataFrame:
    """Sum of ``value`` in one column per listed value of ``on``."""
    wide = df.groupBy(*keys).pivot(on, list(values)).agg(F.sum(value))
    if fill is None:
        return wide
    return wide.select(
        *keys, *[F.coalesce(F.col(f"`{v}`"), F.lit(fill)).alias(v) for v in values])


def sum_horizons(df: DataFrame, keys: Sequence[str], columns: Mapping[str, str]) -> DataFrame:
    """Sums many columns in one pass; ``columns`` maps source names to output names."""
    return df.groupBy(*keys).agg(*[F.sum(F.col(f"`{c}`")).alias(n) for c, n in columns.items()])


def reaggregate(df: DataFrame, keys: Sequence[str], values: Sequence[str],
                fill: object = 0) -> DataFrame:
    """Second grouping of an already pivoted result."""
    return df.groupBy(*keys).agg(
        *[F.coalesce(F.sum(F.col(f"`{v}`")), F.lit(fill)).alias(v) for v in values])


def max_of(df: DataFrame, column: str):
    """Greatest value of a column: one row reaches the driver."""
    return df.agg(F.max(column)).first()[0]


def count_where(df: DataFrame, keys: Sequence[str] = (), **conditions: Column) -> DataFrame:
    counts = [F.count_if(c).alias(name) for name, c in conditions.items()]
    return df.groupBy(*keys).agg(*counts) if keys else df.agg(*counts)


def collect_sorted(df: DataFrame, keys: Sequence[str], column: str, name: str) -> DataFrame:
    """Distinct values per group as one sorted array. For columns with few values."""
    pairs = df.select(*keys, column).distinct()
    return pairs.groupBy(*keys).agg(F.sort_array(F.collect_list(column)).alias(name))


def joined_names(df: DataFrame, keys: Sequence[str], column: str, separator: str = " / ") -> DataFrame:
    """Values per group as one text, in alphabetical order."""
    arrays = df.groupBy(*keys).agg(F.sort_array(F.collect_list(column)).alias(column))
    return arrays.withColumn(column, F.array_join(column, separator))


def distinct_by(df: DataFrame, keys: Sequence[str], column: str, name: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count_distinct(column).alias(name))


#: Buckets of a sketch as a power of two; three standard errors of united sketches are 3 * 1.04 / sqrt(2 ** 14), below 2.5 %.
SKETCH_BITS, SKETCH_BOUND = 14, 0.025


def distinct_sketches(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Per group and column a sketch of the distinct values, 16 KB at most, from which counts of united groups can be read."""
    return df.groupBy(*keys).agg(*[F.hll_sketch_agg(F.col(c).cast("string"), F.lit(SKETCH_BITS)).alias(c) for c in columns])


def united_counts(sketches: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Distinct counts over all sketches of a group, each within SKETCH_BOUND of the exact one (three standard errors)."""
    counts = [F.hll_sketch_estimate(F.hll_union_agg(c)).alias(c) for c in columns]
    return sketches.groupBy(*keys).agg(*counts) if keys else sketches.agg(*counts)


def range_by(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.min(column).alias(f"{column}_min"), F.max(column).alias(f"{column}_max"))


def distinct_on(df: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    return df.dropDuplicates(list(keys)) if keys else df.distinct()


def group_expr(df: DataFrame, groups: Mapping[str, Column], **measures: Column) -> DataFrame:
    """Grouping by computed columns."""
    return df.groupBy(*[c.alias(n) for n, c in groups.items()]).agg(
        *[m.alias(n) for n, m in measures.items()])


def having(df: DataFrame, keys: Sequence[str], condition: Column, **measures: Column) -> DataFrame:
    """Aggregates and keeps the groups that meet a condition on the results."""
    return df.groupBy(*keys).agg(*[m.alias(n) for n, m in measures.items()]).where(condition)


def row_shares(df: DataFrame, columns: Sequence[str], digits: int = 2,
               value_prefix: str = "", share_prefix: str = "%_") -> DataFrame:
    """Adds the percentage of each column in the row's total."""
    total = total_of([F.col(f"`{c}`").cast("bigint") for c in columns], "bigint")
    others = [F.col(f"`{c}`") for c in df.columns if c not in columns]
    return df.select(
        *others,
        *[F.col(f"`{c}`").alias(f"{value_prefix}{c}") for c in columns],
        *[percent(F.col(f"`{c}`"), total, digits).alias(f"{share_prefix}{c}") for c in columns],
    )


def sum_with_total(df: DataFrame, keys: Sequence[str], part: str, measures: Mapping[str, Column],
                   total: str = "TTL", name: str = "sheet") -> DataFrame:
    """The measures per part and over all parts, in one pass over the rows.

    Rows whose part is NULL count in the total only.
    """
    cube = df.groupingSets(
        [[F.col(k) for k in keys], [F.col(part), *[F.col(k) for k in keys]]],
        F.col(part), *[F.col(k) for k in keys],
    ).agg(F.grouping(part).alias("_is_total"), *[m.alias(n) for n, m in measures.items()])
    sheet = F.when(F.col("_is_total") == 1, F.lit(total)).otherwise(F.col(part))
    return cube.select(sheet.alias(name), *keys, *measures).where(F.col(name).isNotNull())


def keep_one_to_one(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose keys occur once. A group of one is its own minimum, so no window is needed."""
    rest = [c for c in df.columns if c not in keys]
    single = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), *[F.min(c).alias(c) for c in rest])
    return single.where("_n = 1").select(*df.columns)


def fan_out_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All rows whose keys occur more than once; NULL is a key like any other."""
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    side = null_safe_side(repeated, keys)
    return df.join(side, null_safe(df, side, keys), "left_semi")


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Stacks results by column name; columns a result lacks become NULL."""
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame, allowMissingColumns=True)
    return first

"""Ranks and running totals over groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from partflow.operators.joins import null_safe, null_safe_side
from partflow.session import settle


def ranked_totals(
    df: DataFrame,
    groups: Sequence[str],
    value: str,
    tie_break: Sequence[str],
    chunks: int | None = None,
) -> DataFrame:
    """Adds ``rank``, ``running`` and ``total`` of ``value``, greatest first in each group.

    A plain ordered window would put a whole group into one task. Here the rows are
    range-partitioned by (group, value, tie-break) and settled; every range adds up for
    itself, and only the sums of the ranges are accumulated over the group. The result
    equals the plain window.
    """
    chunks = chunks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col(value).desc(), *[F.col(c).asc() for c in tie_break]]
    # The range borders come from a sample, so the placement is settled before it is read twice.
    placed = settle(
        df.repartitionByRange(chunks, *[F.col(g) for g in groups], *order)
        .withColumn("_chunk", F.spark_partition_id()))
    sums = placed.groupBy(*groups, "_chunk").agg(
        F.sum(value).alias("_sum"), F.count(F.lit(1)).alias("_rows"))
    # At most one row per range and group border: chunks + number of groups in all.
    before = Window.partitionBy(*groups).orderBy("_chunk").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = sums.select(
        *groups, "_chunk",
        F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_sum_before"),
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_rows_before"),
        F.sum("_sum").over(Window.partitionBy(*groups)).alias("total"),
    )
    within = Window.partitionBy(*groups, "_chunk").orderBy(*order)
    local = placed.select(
        "*",
        F.row_number().over(within).alias("_row"),
        F.sum(value).over(within.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        .alias("_run"),
    )
    # A group may be NULL, and so may any part of it.
    at = [*groups, "_chunk"]
    offsets = null_safe_side(offsets, at, "_sum_before", "_rows_before", "total")
    return local.join(offsets, null_safe(local, offsets, at)).select(
        *[local[c] for c in df.columns],
        (F.col("_row") + F.col("_rows_before")).cast("int").alias("rank"),
        (F.col("_run") + F.col("_sum_before")).alias("running"),
        "total",
    )

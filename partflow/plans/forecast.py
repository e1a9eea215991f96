"""Forecast: typing, unpivot, previous cycle, accuracy and negative groups."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from partflow.config import (
    FORECAST_GROUP, FORECAST_IDS, HORIZON, NEGATIVE_LIMIT, REFINED_LAGS,
)
from partflow.functions.codes import class_tag, strip_market
from partflow.functions.dates import label_of, month_label, shift_month
from partflow.functions.labels import (
    CHANNEL_MARKETS, FORECAST_MARKET_LABELS, SEGMENT_LABELS, label,
)
from partflow.functions.numbers import blank_to_zero
from partflow.operators.aggregate import max_of, sum_by_month, sum_horizons
from partflow.operators.joins import unprocessed
from partflow.operators.project import consumer_view, with_audit
from partflow.plans.enrich import enrich_chain

REFINED_AUDIT = ("_ingested_at", "_ingested_by", "_load_type", "_load_id")


def forecast_typed(raw: DataFrame) -> DataFrame:
    """All-text forecast to its types: the cycle a date, horizons doubles, blanks zero."""
    present = [h for h in HORIZON if h in raw.columns]
    return raw.select(*[
        F.col(c).cast("date").alias(c) if c == "forecast_cycle"
        else blank_to_zero(F.col(f"`{c}`")).cast("double").alias(c) if c in present
        else F.col(f"`{c}`").cast("string").alias(c)
        for c in raw.columns
    ])


def unpivot_horizon(wide: DataFrame, ids: Sequence[str], horizon: Sequence[str] = HORIZON) -> DataFrame:
    """One row per horizon column: ``lag`` and ``forecast_qty``."""
    cells = F.array(*[
        F.struct(F.lit(int(h.removeprefix("n+"))).alias("lag"), F.col(f"`{h}`").alias("forecast_qty"))
        for h in horizon])
    return wide.select(*ids, F.explode(cells).alias("_c")).select(*ids, "_c.lag", "_c.forecast_qty")


def forecast_refined(raw: DataFrame, chain: DataFrame, done: DataFrame | None = None,
                     lags: int = REFINED_LAGS, gathered: bool = False) -> DataFrame:
    """Long forecast of the loads not taken over yet, with main items and clean labels.

    Only the horizons that are kept are unpivoted, and the chain is looked up and labels are cleaned per wide
    row, before the unpivot multiplies the rows. Zero quantities of type ``Enrich`` are
    dropped; a row for which that test is unknown is dropped too. With ``gathered`` the rows of a load come in few tasks: the wide
    rows are moved, not the long ones.
    """
    rows = unprocessed(raw, done, "_load_id", "_raw_load_id")
    rows = enrich_chain(rows, chain, "main_material", "segment", "_principal").withColumns({
        "department": strip_market(F.col("department")), "_tag": class_tag(F.col("forecast_classification"))})
    ids = [*FORECAST_IDS, "_principal", "_tag", "_load_id"]
    if gathered:
        rows = rows.select(*ids, *[F.col(f"`{h}`") for h in HORIZON[:lags]]).hint("rebalance", F.col("_load_id"))
    long = unpivot_horizon(rows, ids, HORIZON[:lags])
    no_enrich_zero = ~((F.col("forecast_type") == "Enrich") & (F.col("forecast_qty") == 0))
    return long.where(no_enrich_zero).select(
        "forecast_cycle", "department", "forecast_type",
        "segment", "market", F.col("main_material").alias("material"),
        F.col("_principal").alias("main_material"), "forecast_classification",
        F.col("_tag").alias("forecast_classification_tag"),
        "lag", F.expr("add_months(forecast_cycle, lag)").alias("forecast_month"), "forecast_qty",
        F.col("_load_id").alias("_raw_load_id"))


def publish_refined(refined: DataFrame, load_id: str, now: Column, user: str) -> DataFrame:
    return with_audit(refined, load_id, now, user, "incremental", REFINED_AUDIT)


def forecast_view(refined: DataFrame) -> DataFrame:
    return consumer_view(refined, hidden=(*REFINED_AUDIT, "_raw_load_id"))


def forecast_prev(raw: DataFrame, chain: DataFrame, cycle: date | None = None,
                  by_channel: bool = True) -> DataFrame:
    """The 35 months after a cycle (the latest unless given) per segment, channel and item."""
    cycle = cycle or max_of(raw, "forecast_cycle")
    months = {f"n+{i}": label_of(shift_month(cycle, i)) for i in range(1, len(HORIZON))}
    rows = enrich_chain(raw.where(F.col("forecast_cycle") == F.lit(cycle)), chain,
                        "main_material", "segment")
    labelled = rows.withColumns({
        "ciclo": month_label(F.col("forecast_cycle")),
        "segmento": label(F.col("segment"), SEGMENT_LABELS, F.col("segment")),
        "canal": label(F.col("market"), FORECAST_MARKET_LABELS, F.col("market")),
    })
    keys = ["ciclo", "segmento", *(["canal"] if by_channel else []),
            "item_principal_cadeia", "forecast_classification"]
    return sum_horizons(labelled, keys, months)


def forecast_prev_slices(raw: DataFrame, chain: DataFrame, cycle: date | None = None) -> dict[str, DataFrame]:
    """The six deliveries: per segment each channel, and all channels together."""
    cycle = cycle or max_of(raw, "forecast_cycle")
    per_channel = forecast_prev(raw, chain, cycle)
    together = forecast_prev(raw, chain, cycle, by_channel=False)
    slices = {}
    for segment in SEGMENT_LABELS.values():
        wheels = segment[:2]
        for channel in FORECAST_MARKET_LABELS.values():
            slices[f"Forecast N-1 {wheels} {channel} {cycle:%Y-%m}"] = per_channel.where(
                (F.col("segmento") == segment) & (F.col("canal") == channel))
        slices[f"Forecast N-1 {wheels} {cycle:%Y-%m}"] = together.where(F.col("segmento") == segment)
    return slices


def forecast_accuracy(refined: DataFrame, base: DataFrame, lag: int = 3) -> DataFrame:
    """Forecast made ``lag`` months ahead against the demand of the month.

    Both sides are summed to one row per key before they meet.
    """
    forecast = refined.where(F.col("lag") == lag).groupBy(
        "segment", "market", "main_material", "forecast_month",
    ).agg(F.sum("forecast_qty").alias("forecast_qty"))
    actual = sum_by_month(
        base, ["organizacao_vendas", "canal_distribuicao", "item_principal_cadeia"],
        "data_ordem", "quantidade", "forecast_month")
    channel = F.col("canal_distribuicao")
    actual = actual.select(
        F.col("organizacao_vendas").alias("segment"),
        label(channel, CHANNEL_MARKETS, channel).alias("market"),
        F.col("item_principal_cadeia").alias("main_material"), "forecast_month",
        F.col("quantidade").alias("actual_qty"))
    return forecast.join(actual, ["segment", "market", "main_material", "forecast_month"])


def forecast_metrics(accuracy: DataFrame) -> DataFrame:
    """Error, absolute error, absolute percentage error and accuracy; NULL without demand."""
    error = F.col("forecast_qty") - F.col("actual_qty")
    relative = F.when(F.col("actual_qty") != 0, F.abs(error) / F.abs(F.col("actual_qty")))
    return accuracy.withColumns({
        "error": error, "abs_error": F.abs(error), "abs_pct_error": relative,
        "accuracy": 1 - relative,
    })


def forecast_groups(refined: DataFrame) -> DataFrame:
    return refined.groupBy(*FORECAST_GROUP).agg(F.sum("forecast_qty").alias("forecast_qty"))


def latest_refined_cycle(refined: DataFrame, raw: DataFrame) -> date | None:
    """The greatest cycle of the refined rows of ``raw``, sought from its latest cycle down.

    The refined rows are made for the latest cycles only, most often one; a maximum would make all of them.
    """
    cycles = raw.select("forecast_cycle").where(F.col("forecast_cycle").isNotNull()).distinct().collect()
    for cycle in sorted((row.forecast_cycle for row in cycles), reverse=True):
        if not refined.where(F.col("forecast_cycle") == F.lit(cycle)).isEmpty():
            return cycle
    return None


def cycle_window(df: DataFrame, latest: date | None, cycles: int) -> DataFrame:
    if latest is None:
        latest = max_of(df, "forecast_cycle")
    return df.where(F.col("forecast_cycle").between(
        F.lit(shift_month(latest, 1 - cycles)), F.lit(latest)))


def forecast_export(refined: DataFrame, cycles: int = 7, latest: date | None = None,
                    limit: float = NEGATIVE_LIMIT) -> DataFrame:
    """Group sums of the last cycles; groups that sum up below the limit are left out."""
    return forecast_groups(cycle_window(refined, latest, cycles)).where(F.col("forecast_qty") >= limit)


def forecast_negatives(refined: DataFrame, limit: float = NEGATIVE_LIMIT) -> DataFrame:
    """Groups of all cycles whose sum is negative beyond rounding noise."""
    return forecast_groups(refined).where(F.col("forecast_qty") < limit)


# Columns of the investigation file after the group keys.
DETAIL_COLUMNS = (
    "forecast_qty_total_grupo", "lag", "forecast_type", "department", "market",
    "main_material", "forecast_classification", "forecast_qty",
)


def forecast_negative_detail(refined: DataFrame, limit: float = NEGATIVE_LIMIT,
                             extra: Sequence[str] = ()) -> DataFrame:
    """The source rows behind each negative group, in one pass; a group is a handful of lags."""
    total = F.sum("forecast_qty").over(Window.partitionBy(*FORECAST_GROUP))
    return refined.withColumn("forecast_qty_total_grupo", total).where(
        F.col("forecast_qty_total_grupo") < limit).select(*FORECAST_GROUP, *DETAIL_COLUMNS, *extra)

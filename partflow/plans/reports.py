"""Report queries over the published views."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partflow.config import MOTORCYCLES, REFINED_LAGS
from partflow.functions.codes import adjusted_center
from partflow.functions.dates import label_of, month_label, month_start
from partflow.functions.labels import ORIGIN_LABELS, label
from partflow.operators.aggregate import reaggregate, static_pivot, union_all
from partflow.operators.joins import latest_only, lookup_join
from partflow.operators.project import optional_eq

# Purchased items of the cockpit.
COCKPIT_ORIGIN = "1"
COCKPIT_BUYERS = ("042", "043")


def report_center_adjusted(base: DataFrame, months: Sequence[date], org: str = MOTORCYCLES) -> DataFrame:
    """Demand by item, state and centre, with the centres that serve other states."""
    rows = base.where((F.col("organizacao_vendas") == org) & (F.col("data_ordem") >= F.lit(months[0])))
    keyed = rows.select(
        "segmento", "item_principal_cadeia", "uf_cliente",
        F.col("centro_distribuicao_original").alias("centro_original"),
        adjusted_center(F.col("uf_cliente"), F.col("centro_distribuicao_original"))
        .alias("centro_ajustado"),
        month_label(F.col("data_ordem")).alias("ano_mes"), "quantidade")
    keys = ["segmento", "item_principal_cadeia", "uf_cliente", "centro_original", "centro_ajustado"]
    return static_pivot(keyed, keys, "ano_mes", [label_of(m) for m in months], "quantidade", fill=0)


def cockpit_materials(view: DataFrame, org: str, items: Sequence[str], dedup: bool) -> DataFrame:
    """Materials of the cockpit per item, origin and buyer, with their number.

    ``dedup`` counts every item once, under its smallest origin and buyer.
    """
    purchased = (F.col("origem") == COCKPIT_ORIGIN) & F.col("grupo_de_compradores").isin(*COCKPIT_BUYERS)
    chosen = view.where((F.col("empresa") == org)
                        & (purchased | F.col("item_principal_cadeia").isin(*items)))
    if dedup:
        first = F.min(F.struct("origem", "grupo_de_compradores")).alias("m")
        return chosen.groupBy("empresa", "item_principal_cadeia").agg(first).select(
            "empresa", "item_principal_cadeia", "m.*", F.lit(1).cast("bigint").alias("_materials"))
    return chosen.groupBy("empresa", "item_principal_cadeia", "origem", "grupo_de_compradores").agg(
        F.count(F.lit(1)).alias("_materials"))


def attach_origin(sums: DataFrame, view: DataFrame, org_column: str, item_column: str, org: str,
                  items: Sequence[str], dedup: bool = False) -> DataFrame:
    """Adds origin and buyer to sums per item.

    Several materials share an item, so each sum counts once per material. Both sides
    come with one row per key; the number of materials stands for the repeated rows.
    """
    materials = cockpit_materials(view, org, items, dedup)
    return lookup_join(sums, materials, {org_column: "empresa", item_column: "item_principal_cadeia"},
                       how="inner").withColumns({
                           "empresa": F.col(org_column),
                           "descricao_origem": label(F.col("origem"), ORIGIN_LABELS, F.col("origem"))})


COCKPIT_KEYS = ("empresa", "origem", "descricao_origem", "grupo_de_compradores")


def report_demand_origin(base: DataFrame, view: DataFrame, start: date | None, org: str = MOTORCYCLES,
                         *, items: Sequence[str], dedup: bool = False) -> DataFrame:
    """Demand by origin and buyer since a date (since ever when absent); ``items`` are shown whatever their origin."""
    since = F.lit(True) if start is None else F.col("data_ordem") >= F.lit(start)
    sums = base.where(since & (F.col("organizacao_vendas") == org)).groupBy(
        "organizacao_vendas", "item_principal_cadeia").agg(F.sum("quantidade").alias("_q"))
    rows = attach_origin(sums.withColumnRenamed("item_principal_cadeia", "_item"), view,
                         "organizacao_vendas", "_item", org, items, dedup)
    return rows.groupBy(*COCKPIT_KEYS).agg(
        F.sum(F.col("_q") * F.col("_materials")).alias("total_demanda"))


def report_forecast_origin(refined: DataFrame, view: DataFrame, first: str | None, last: str | None,
                           org: str = MOTORCYCLES, *, items: Sequence[str], dedup: bool = False) -> DataFrame:
    """Forecast of the latest cycle by origin and buyer; bad dates select nothing."""
    month = F.col("forecast_month")
    rows = latest_only(refined, "forecast_cycle").where(
        (F.col("segment") == org) & (month >= F.try_to_date(F.lit(first)))
        & (month <= F.try_to_date(F.lit(last))))
    sums = rows.groupBy("segment", F.col("material").alias("_item")).agg(
        F.sum("forecast_qty").alias("_q"))
    origin = attach_origin(sums, view, "segment", "_item", org, items, dedup)
    return origin.groupBy(*COCKPIT_KEYS).agg(
        F.round(F.sum(F.col("_q") * F.col("_materials")), 0).alias("total_forecast"))


def report_blocked_stock(inventory: DataFrame, chain: DataFrame, months: Sequence[date]) -> DataFrame:
    """Blocked stock of the first day of each month per chain item."""
    lookup = chain.select("empresa", "material", F.col("item_principal_cadeia").alias("item_principal"))
    rows = lookup_join(inventory, lookup, {"material": "material", "empresa": "empresa"}, how="inner")
    labels = [label_of(m) for m in months]
    monthly = rows.groupBy("item_principal", month_label(F.col("reference_date")).alias("mes")).agg(
        F.sum("estoque_bloqueado").alias("estoque_bloqueado"))
    wide = static_pivot(monthly, ["item_principal"], "mes", labels, "estoque_bloqueado")
    return reaggregate(wide, ["item_principal"], labels)


def report_actual_vs_forecast(base: DataFrame, forecast: DataFrame, cycles: Mapping[str, date],
                              start: date, end: date, item: str | None = None) -> DataFrame:
    """Demand and the forecasts of some cycles as one long series by month.

    ``cycles`` names the forecast columns. Without an item all items count.
    """
    month = month_start(F.col("data_ordem")).alias("mes")
    actual = base.where(
        optional_eq(F.col("item_principal_cadeia"), item)
        & (F.col("data_ordem") >= F.lit(start)) & (F.col("data_ordem") < F.lit(end))
    ).groupBy(month).agg(F.sum("quantidade").alias("valor"))
    # One pass over all cycles; each series then takes its rows.
    sums = forecast.where(
        optional_eq(F.col("main_material"), item) & (F.col("lag") < REFINED_LAGS)
        & F.col("forecast_cycle").isin(*[F.lit(c) for c in cycles.values()])
    ).groupBy("forecast_cycle", F.col("forecast_month").alias("mes")).agg(
        F.sum("forecast_qty").alias("valor"))
    names = F.lit(None).cast("string")
    for name, cycle in cycles.items():
        names = F.when(F.col("forecast_cycle") == F.lit(cycle), name).otherwise(names)
    series = actual.select(F.lit("demanda_real").alias("_serie"), "mes", F.col("valor").cast("double")
                           ).unionByName(sums.select(names.alias("_serie"), "mes", "valor"))
    return series.select("mes", *[
        F.when(F.col("_serie") == n, F.col("valor")).alias(n) for n in ("demanda_real", *cycles)])


def series_by_month(series: DataFrame) -> DataFrame:
    """The chart behind the series: one row per month."""
    return series.groupBy("mes").agg(*[F.sum(c).alias(c) for c in series.columns if c != "mes"])


def report_forecast_department(forecast: DataFrame, material: str | None = None, kind: str | None = None,
                               segment: str | None = None, market: str | None = None,
                               cycle_label: str | None = None) -> DataFrame:
    """Forecast by department and month under optional filters."""
    wanted: list[Column] = [
        optional_eq(F.col("main_material"), material), optional_eq(F.col("forecast_type"), kind),
        optional_eq(F.col("segment"), segment), optional_eq(F.col("market"), market),
        optional_eq(month_label(F.col("forecast_cycle")), cycle_label),
    ]
    for condition in wanted:
        forecast = forecast.where(condition)
    return forecast.groupBy("department", "forecast_month").agg(
        F.sum("forecast_qty").alias("forecast_qty"))


def report_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    return union_all([
        df.agg(F.count(F.lit(1)).alias("linhas")).select(F.lit(name).alias("tabela"), "linhas")
        for name, df in tables.items()])


def report_latest(df: DataFrame, n: int = 100) -> DataFrame:
    """The rows that come last by the first column."""
    return df.orderBy(*[F.col(f"`{c}`").desc() for c in df.columns]).limit(n)

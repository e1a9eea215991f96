"""Monthly demand views, ABC curve and distribution.

A view is a row of ``config.DEMAND_VIEWS``. All views of a closing come from one
aggregation of the demand cube: its rows are dealt by item and month, stand for the total and the centre sheets
from there on, and its conditional measures give the views.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partflow.config import (
    BOTH, DEMAND_VIEWS, MOTORCYCLES, SEGMENTS, TOTAL_SHEET, DemandView,
)
from partflow.functions.dates import label_of, last_months, shift_month
from partflow.functions.labels import MARKET_TAGS, MONTHS_PT, label
from partflow.functions.numbers import share, trunc_int, zero_if_null
from partflow.operators.aggregate import row_shares, spread_months, static_pivot
from partflow.operators.project import slice_condition
from partflow.operators.running import ranked_totals

# Upper cumulative shares of the classes; the rest is D, zero demand is E.
ABC_CUTS = (("A", 0.75), ("B", 0.85), ("C", 0.95))
ABC_MONTHS = 6
CENTER_MONTHS, MARKET_MONTHS = 6, 12


def file_label(org: Column, anchor: date, suffix: str) -> Column:
    """``HDA 2026 Out Demanda Fechada``."""
    tag = F.lit("OUT")
    for segment in SEGMENTS.values():
        tag = F.when(org == segment.org, segment.tag).otherwise(tag)
    return F.concat_ws(" ", tag, F.lit(f"{anchor.year} {MONTHS_PT[anchor.month - 1][:3]}"),
                       F.lit(suffix))


def _view_condition(view: DemandView) -> Column:
    return slice_condition(channel=view.channel, only_type=view.only_type,
                           exclude_type=view.exclude_type)


def demand_measures(cube: DataFrame, views: Sequence[DemandView],
                    orgs: Sequence[str] = BOTH) -> DataFrame:
    """All views at once: one row per organisation, grain, sheet, item and month.

    Per view ``<key>`` is the measure and ``<key>__n`` the number of sales rows behind it.
    """
    grains = sorted({v.grain for v in views})
    part_grains = {v.grain for v in views if v.center_orgs}
    # One row per item of a cube row: grains that agree in the item share it, as bits of _grains.
    masks = []
    for n, grain in enumerate(grains):
        mask, first = F.lit(1 << n), F.lit(True)
        for m, other in enumerate(grains):
            agree = F.col(grain).eqNullSafe(F.col(other))
            if m > n:
                mask = mask + F.when(agree, 1 << m).otherwise(0)
            elif m < n:
                first = first & ~agree
        masks.append(F.when(first, mask))
    rows = cube.where(F.col("org_vendas").isin(*orgs)).withColumn("_grains", F.explode(F.array(*masks))).where("_grains IS NOT NULL")

    def picked(of: Column, values: Sequence[Column]) -> Column:
        chosen = F.when(of.bitwiseAND(1) != 0, values[0])
        for n, value in enumerate(values[1:], 1):
            chosen = chosen.when(of.bitwiseAND(1 << n) != 0, value)
        return chosen

    # The cube's own measures are moved, not those of all views and sheets.
    rows = rows.select(
        "org_vendas", "centro_original", "canal_dist", "tipo_ov", "mes", "quantidade", "linhas", "registros", "_grains",
        picked(F.col("_grains"), [F.col(g) for g in grains]).alias("item")).repartition("org_vendas", "item", "mes")
    allowed = F.lit(False)
    for org in orgs:
        allowed = allowed | ((F.col("org_vendas") == org) & F.col("centro_original").isin(*SEGMENTS[org].centers))
    # A row stands for the total (_part is 0) and for the centre's sheet (1) of each of its grains.
    parts = [F.struct(F.lit(1 << n).alias("grain"), F.lit(part).alias("part"))
             for n, grain in enumerate(grains) for part in range(1 + (grain in part_grains))]
    rows = rows.withColumn("_as", F.explode(F.array(*parts)))
    own, part = F.col("_as.grain"), F.col("_as.part")
    rows = rows.where((F.col("_grains").bitwiseAND(own) != 0) & ((part == 0) | allowed)).withColumns({
        "grain": picked(own, [F.lit(g) for g in grains]),
        "sheet": F.when(part == 0, F.lit(TOTAL_SHEET)).otherwise(F.col("centro_original"))})
    measures = []
    for view in views:
        hit = _view_condition(view)
        source = "quantidade" if view.measure == "sum" else "linhas"
        measures.append(F.sum(F.when(hit, F.col(source))).alias(view.key))
        measures.append(F.sum(F.when(hit, F.col("registros"))).alias(f"{view.key}__n"))
    return rows.groupBy("org_vendas", "grain", "sheet", "item", "mes").agg(*measures)


def view_rows(measures: DataFrame, view: DemandView) -> DataFrame:
    """Long form of one view; an item without sales rows in the view is absent."""
    sheets = (F.col("sheet") == TOTAL_SHEET) | F.col("org_vendas").isin(*view.center_orgs)
    return measures.where(
        (F.col("grain") == view.grain) & (F.col(f"{view.key}__n") > 0) & sheets
    ).select("org_vendas", "sheet", "item", "mes",
             trunc_int(zero_if_null(F.col(view.key))).alias("valor"))


def view_table(rows: DataFrame, view: DemandView, anchor: date,
               extra: dict[str, str] | None = None) -> DataFrame:
    """Presentation of a view: file, sheet, item and one column per month."""
    ids = {"item": view.item_label, **(extra or {})}
    wide = spread_months(rows, ["org_vendas", "sheet", *ids], last_months(anchor, view.months), "valor")
    months = wide.columns[2 + len(ids):]
    return wide.select(
        "org_vendas", file_label(F.col("org_vendas"), anchor, view.suffix).alias("file"), "sheet",
        *[F.col(c).alias(n) for c, n in ids.items()], *[F.col(f"`{m}`") for m in months])


def demand_view(cube: DataFrame, key: str, anchor: date, orgs: Sequence[str] = BOTH) -> DataFrame:
    """One view of the cube in presentation form, with ``org_vendas`` as the first column."""
    view = DEMAND_VIEWS[key]
    return view_table(view_rows(demand_measures(cube, [view], orgs), view), view, anchor)


def urgent_by_customer(customer_cube: DataFrame, anchor: date, orgs: Sequence[str] = BOTH) -> DataFrame:
    view = DEMAND_VIEWS["zpug_cliente"]
    rows = customer_cube.where(F.col("org_vendas").isin(*orgs) & _view_condition(view)).select(
        "org_vendas", F.lit(TOTAL_SHEET).alias("sheet"), F.col("item_principal_cadeia").alias("item"),
        "emissor_da_ordem", "mes", "quantidade",
    ).groupBy("org_vendas", "sheet", "item", "emissor_da_ordem", "mes").agg(
        trunc_int(zero_if_null(F.sum("quantidade"))).alias("valor"))
    return view_table(rows, view, anchor, {"emissor_da_ordem": "Cliente"})


def abc_curve(line_rows: DataFrame, anchor: date,
              cuts: Sequence[tuple[str, float]] = ABC_CUTS) -> DataFrame:
    """Classes of line demand per sheet over the last six months.

    ``line_rows`` is the long form of the line view over the whole window, so items
    without recent lines are ranked last and get class E.
    """
    months = last_months(anchor, ABC_MONTHS)
    labels = [label_of(m) for m in months]
    wide = spread_months(line_rows, ["org_vendas", "sheet", "item"], months, "valor")
    total = F.lit(0)
    for name in labels:
        total = total + F.col(f"`{name}`")
    ranked = ranked_totals(
        wide.withColumn("sum_6m", trunc_int(total)), ["org_vendas", "sheet"], "sum_6m", ["item"])
    part = share(F.col("sum_6m"), F.col("total"))
    cumulative = share(F.col("running"), F.col("total"))
    grade = F.when(F.col("sum_6m") == 0, "E")
    for name, limit in cuts:
        grade = grade.when(cumulative <= limit, name)
    return ranked.select(
        "org_vendas", file_label(F.col("org_vendas"), anchor, DEMAND_VIEWS["linha"].suffix).alias("file"),
        "sheet", F.col("item").alias("Item Principal Cadeia"), *[F.col(f"`{m}`") for m in labels],
        "sum_6m", part.alias("part_perc"), cumulative.alias("perc_acc"), "rank",
        grade.otherwise("D").alias("classe_linha"))


def demand_abc(cube: DataFrame, anchor: date, orgs: Sequence[str] = (MOTORCYCLES,)) -> DataFrame:
    view = DEMAND_VIEWS["linha"]
    return abc_curve(view_rows(demand_measures(cube, [view], orgs), view), anchor)


def _shares(rows: DataFrame, on: Column, values: Sequence[str]) -> DataFrame:
    """Integer sums per value of ``on`` with their percentages of the row."""
    wide = static_pivot(rows.withColumn("_on", on), ["item_principal_cadeia"], "_on", values,
                        "quantidade", fill=0)
    whole = wide.select("item_principal_cadeia",
                        *[trunc_int(F.col(f"`{v}`")).alias(v) for v in values])
    return row_shares(whole, values, value_prefix="DMD_", share_prefix="%_")


def _known(value: Column, names: Sequence[str], what: str) -> Column:
    """The code, which has to be one that becomes a column; NULL passes."""
    return F.when(value.isNull() | value.isin(*names), value).otherwise(
        F.raise_error(F.concat(F.lit(f"no column for {what} "), value)))


def distribution(cube: DataFrame, org: str, anchor: date, centers: Sequence[str] | None = None,
                 unassigned: str = "bucket", markets: Sequence[str] = ("ME", "MI")) -> DataFrame:
    """Share of centres (6 months) and of markets (12 months) in an item's demand.

    Sales without a centre form the column ``null`` and count in the total
    (``unassigned="bucket"``) or are left out (``"drop"``). The columns are the segment's
    centres and the two markets unless others are given; a code that has no column is an error.
    """
    rows = cube.where((F.col("org_vendas") == org) & (F.col("mes") < F.lit(shift_month(anchor, 1))))
    recent = rows.where(F.col("mes") >= F.lit(shift_month(anchor, 1 - CENTER_MONTHS)))
    if unassigned == "drop":
        recent = recent.where(F.col("centro_original").isNotNull())
    center = F.coalesce(F.col("centro_original"), F.lit("null"))
    year = rows.where(F.col("mes") >= F.lit(shift_month(anchor, 1 - MARKET_MONTHS)))
    market = F.coalesce(label(F.col("canal_dist"), MARKET_TAGS, F.col("canal_dist")), F.lit("null"))
    if centers is None:
        centers = [*SEGMENTS[org].centers, *(["null"] if unassigned == "bucket" else [])]
    center_names, market_names = list(centers), list(markets)
    center, market = _known(center, center_names, "centre"), _known(market, [*market_names, "null"], "market")
    merged = _shares(recent, center, center_names).join(
        _shares(year, market, market_names), "item_principal_cadeia", "full").fillna(0)
    ordered = [f"{p}{c}" for names in (center_names, market_names) for p in ("DMD_", "%_")
               for c in names]
    return merged.select(
        file_label(F.lit(org), anchor, "Distribuição").alias("file"),
        F.lit(TOTAL_SHEET).alias("sheet"),
        F.col("item_principal_cadeia").alias("Item Principal Cadeia"),
        *[F.col(f"`{c}`") for c in ordered])

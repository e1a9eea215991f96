"""Report queries."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partflow.functions.dates import label_of, last_months
from partflow.plans import inventory, materials, reports
from partflow.plans.report_functions import register_reports
from partflow.registry.base import Family
from partflow.registry.demand import Closing
from partflow.registry.fixtures import ANCHOR, Inputs
from partflow.registry.forecast import Forecasts

QUERIES = Family()

_SIX = last_months(ANCHOR, 6)
_PIVOT = ", ".join(
    f"CAST(coalesce(sum(quantidade) FILTER (WHERE strftime(data_ordem, '%Y/%m') = '{label_of(m)}'), 0) AS BIGINT) AS \"{label_of(m)}\""
    for m in _SIX)


@QUERIES.query(f"""
    SELECT segmento, item_principal_cadeia, uf_cliente, centro_distribuicao_original AS centro_original,
      CASE WHEN uf_cliente = 'TO' AND centro_distribuicao_original = '0203' THEN '0209'
        WHEN uf_cliente = 'TO' AND centro_distribuicao_original = '0503' THEN '0505'
        WHEN uf_cliente = 'AP' AND centro_distribuicao_original = '0209' THEN '0232'
        ELSE centro_distribuicao_original END AS centro_ajustado, {_PIVOT}
    FROM ox_base WHERE organizacao_vendas = '0200' AND data_ordem >= DATE '{_SIX[0]}' GROUP BY 1, 2, 3, 4, 5""")
def report_center_adjusted(inputs: Inputs) -> DataFrame:
    return reports.report_center_adjusted(Closing(inputs).base(), _SIX)


# Items of the given tables that the cockpit shows whatever their origin.
ITEMS = ("M10", "M25", "M40 C", "M55")
_CHOSEN = f"""cad.empresa = '0200' AND ((cad.origem = '1' AND cad.grupo_de_compradores IN ('042', '043'))
    OR cad.item_principal_cadeia IN ({", ".join(f"'{i}'" for i in ITEMS)}))"""
_ORIGIN = """CASE cad.origem WHEN '1' THEN 'Fornecedor São Paulo' WHEN '2' THEN 'Fábrica HDA' WHEN '3' THEN 'Importado'
    WHEN '4' THEN 'Fornecedor Manaus' WHEN '5' THEN 'Fábrica HAB' ELSE cad.origem END AS descricao_origem"""


@QUERIES.query(f"""
    SELECT cad.empresa, cad.origem, {_ORIGIN}, cad.grupo_de_compradores, CAST(sum(d.quantidade) AS BIGINT) AS total_demanda
    FROM ox_base d JOIN ox_view cad ON cad.empresa = d.organizacao_vendas
      AND cad.item_principal_cadeia = d.item_principal_cadeia
    WHERE d.data_ordem >= DATE '2000-09-01' AND {_CHOSEN} GROUP BY 1, 2, 3, 4""")
def report_demand_origin(inputs: Inputs) -> DataFrame:
    view = materials.material_view(inputs.view("fx_master"))
    return reports.report_demand_origin(Closing(inputs).lean_base(), view, date(2000, 9, 1), items=ITEMS)


@QUERIES.query(f"""
    SELECT cad.empresa, cad.origem, {_ORIGIN}, cad.grupo_de_compradores, CAST(sum(d.quantidade) AS BIGINT) AS total_demanda
    FROM ox_base d JOIN (SELECT DISTINCT ON (empresa, item_principal_cadeia) * FROM ox_view cad WHERE {_CHOSEN}
      ORDER BY empresa, item_principal_cadeia, origem, grupo_de_compradores NULLS FIRST) cad
      ON cad.empresa = d.organizacao_vendas AND cad.item_principal_cadeia = d.item_principal_cadeia
    WHERE d.data_ordem >= DATE '2000-09-01' GROUP BY 1, 2, 3, 4""")
def report_demand_origin_dedup(inputs: Inputs) -> DataFrame:
    view = materials.material_view(inputs.view("fx_master"))
    return reports.report_demand_origin(
        Closing(inputs).lean_base(), view, date(2000, 9, 1), items=ITEMS, dedup=True)


@QUERIES.query(f"""
    SELECT cad.empresa, cad.origem, {_ORIGIN}, cad.grupo_de_compradores, round(sum(f.forecast_qty), 0) AS total_forecast
    FROM ox_refined f JOIN ox_view cad ON cad.empresa = f.segment AND cad.item_principal_cadeia = f.material
    WHERE f.forecast_cycle = (SELECT max(forecast_cycle) FROM ox_refined)
      AND f.forecast_month BETWEEN DATE '2001-06-01' AND DATE '2001-12-01' AND {_CHOSEN} GROUP BY 1, 2, 3, 4""")
def report_forecast_origin(inputs: Inputs) -> DataFrame:
    view = materials.material_view(inputs.view("fx_master"))
    return reports.report_forecast_origin(
        Forecasts(inputs).refined(), view, "2001-06-01", "2001-12-01", items=ITEMS)


def report_functions(inputs: Inputs) -> None:
    """The SQL functions over the views of the given tables."""
    Closing(inputs).lean_base().createOrReplaceTempView("demand_base")
    materials.material_view(inputs.view("fx_master")).createOrReplaceTempView("material_view")
    Forecasts(inputs).refined().createOrReplaceTempView("refined_forecast")
    register_reports(inputs.spark)


_DEMAND_ORIGIN = f"""
    SELECT cad.empresa, cad.origem, {_ORIGIN}, cad.grupo_de_compradores, CAST(sum(d.quantidade) AS BIGINT) AS total_demanda
    FROM ox_base d JOIN {{cad}} cad ON cad.empresa = d.organizacao_vendas AND cad.item_principal_cadeia = d.item_principal_cadeia
    WHERE {{where}} GROUP BY 1, 2, 3, 4"""
_ONCE = f"""(SELECT DISTINCT ON (empresa, item_principal_cadeia) * FROM ox_view cad WHERE {_CHOSEN}
    ORDER BY empresa, item_principal_cadeia, origem, grupo_de_compradores NULLS FIRST)"""


@QUERIES.query(_DEMAND_ORIGIN.format(cad=_ONCE, where="d.data_ordem >= DATE '2000-09-01'"))
def sql_demand_origin(inputs: Inputs) -> DataFrame:
    """The report as a SQL function with named arguments, every item counted once."""
    report_functions(inputs)
    return inputs.spark.sql(
        "SELECT * FROM demand_by_origin(since => CAST(:since AS DATE), org => :org, items => :items, once => true)",
        args={"since": "2000-09-01", "org": "0200", "items": F.array(*map(F.lit, ITEMS))})


_BOUGHT = "cad.origem = '1' AND cad.grupo_de_compradores IN ('042', '043')"


@QUERIES.query(_DEMAND_ORIGIN.format(cad="ox_view", where=_BOUGHT))
def sql_demand_origin_all(inputs: Inputs) -> DataFrame:
    """Without arguments: all organisations, all dates, purchased items only."""
    report_functions(inputs)
    return inputs.spark.sql("SELECT * FROM demand_by_origin()")


@QUERIES.query(f"""
    SELECT cad.empresa, cad.origem, {_ORIGIN}, cad.grupo_de_compradores, round(sum(f.forecast_qty), 0) AS total_forecast
    FROM ox_refined f JOIN ox_view cad ON cad.empresa = f.segment AND cad.item_principal_cadeia = f.material
    WHERE f.forecast_cycle = DATE '2001-04-01' AND f.forecast_month >= DATE '2001-06-01' AND {_CHOSEN} GROUP BY 1, 2, 3, 4""")
def sql_forecast_origin(inputs: Inputs) -> DataFrame:
    report_functions(inputs)
    return inputs.spark.sql("""SELECT * FROM forecast_by_origin(
        first => DATE '2001-06-01', org => '0200', items => :items, cycle => DATE '2001-04-01')""",
                            args={"items": F.array(*map(F.lit, ITEMS))})


@QUERIES.query("""
    SELECT CAST(NULL AS DATE) AS cycle, CAST(date_trunc('month', data_ordem) AS DATE) AS mes, CAST(sum(quantidade) AS DOUBLE) AS valor
    FROM ox_base WHERE item_principal_cadeia = 'M10' AND data_ordem < DATE '2001-08-01' GROUP BY 2
    UNION ALL SELECT forecast_cycle, forecast_month, sum(forecast_qty) FROM ox_refined
    WHERE main_material = 'M10' AND lag <= 11 AND forecast_cycle IN (DATE '2001-03-01', DATE '2001-05-01') GROUP BY 1, 2""")
def sql_actual_and_forecast(inputs: Inputs) -> DataFrame:
    report_functions(inputs)
    return inputs.spark.sql("""SELECT * FROM actual_and_forecast(before => DATE '2001-08-01', item => :item,
        cycles => array(DATE '2001-03-01', DATE '2001-05-01'))""", args={"item": "M10"})


_STOCK_MONTHS = [date(2001, 7, 1), date(2001, 8, 1)]


@QUERIES.query("""
    SELECT item_principal_cadeia AS item_principal,
      CAST(coalesce(sum(estoque_bloqueado) FILTER (WHERE centro LIKE '%3'), 0) * 2 AS DECIMAL(38,2)) AS "2001/07",
      CAST(coalesce(sum(estoque_bloqueado), 0) AS DECIMAL(38,2)) AS "2001/08"
    FROM ox_inventory h JOIN ox_chain c ON h.material = c.material AND h.empresa = c.empresa GROUP BY 1""")
def report_blocked_stock(inputs: Inputs) -> DataFrame:
    snapshot = inventory.inventory_rows(inputs.view("fx_stock"), ANCHOR)
    # The month before: the centres that end in 3, with twice their blocked stock.
    before = snapshot.where("centro LIKE '%3'").withColumns({
        "reference_date": F.lit(_STOCK_MONTHS[0]), "estoque_bloqueado": (F.col("estoque_bloqueado") * 2).cast("decimal(18,2)")})
    snapshot = snapshot.unionByName(before.select(*snapshot.columns))
    chain = materials.material_chain(inputs.view("fx_master"))
    report = reports.report_blocked_stock(snapshot, chain, _STOCK_MONTHS)
    return report.select("item_principal", *[
        F.col(f"`{label_of(m)}`").cast("decimal(38,2)").alias(label_of(m)) for m in _STOCK_MONTHS])


_CYCLES = {"forecast_marco": date(2001, 3, 1), "forecast_abril": date(2001, 4, 1), "forecast_maio": date(2001, 5, 1)}


def series_sql(item: str | None) -> str:
    real = f"AND item_principal_cadeia = '{item}'" if item else ""
    planned = f"AND main_material = '{item}'" if item else ""
    nulls = {n: "CAST(NULL AS DOUBLE)" for n in _CYCLES}
    parts = [f"""SELECT CAST(date_trunc('month', data_ordem) AS DATE) AS mes, CAST(sum(quantidade) AS DOUBLE) AS demanda_real,
        {", ".join(f"{v} AS {n}" for n, v in nulls.items())} FROM ox_base
        WHERE data_ordem >= DATE '1999-10-01' AND data_ordem < DATE '2001-08-01' {real} GROUP BY 1"""]
    for name, cycle in _CYCLES.items():
        columns = ", ".join(f"{'sum(forecast_qty)' if n == name else v} AS {n}" for n, v in nulls.items())
        parts.append(f"""SELECT forecast_month, CAST(NULL AS DOUBLE), {columns} FROM ox_refined
            WHERE forecast_cycle = DATE '{cycle}' AND lag <= 11 {planned} GROUP BY 1""")
    return " UNION ALL ".join(parts)


def series(inputs: Inputs, item: str | None) -> DataFrame:
    return reports.report_actual_vs_forecast(
        Closing(inputs).lean_base(), Forecasts(inputs).refined(), _CYCLES, date(1999, 10, 1),
        date(2001, 8, 1), item)


@QUERIES.query(series_sql(None))
def report_actual_vs_forecast(inputs: Inputs) -> DataFrame:
    return series(inputs, None)


@QUERIES.query(series_sql("M10"))
def optional_filter(inputs: Inputs) -> DataFrame:
    return series(inputs, "M10")


@QUERIES.query(f"""SELECT mes, sum(demanda_real) AS demanda_real, {", ".join(f"sum({n}) AS {n}" for n in _CYCLES)}
    FROM ({series_sql(None)}) GROUP BY mes""")
def report_series_chart(inputs: Inputs) -> DataFrame:
    return reports.series_by_month(series(inputs, None))


@QUERIES.query("""
    SELECT department, forecast_month, sum(forecast_qty) AS forecast_qty FROM ox_refined
    WHERE segment = '0200' AND strftime(forecast_cycle, '%Y/%m') = '2001/05' GROUP BY 1, 2""")
def report_forecast_department(inputs: Inputs) -> DataFrame:
    return reports.report_forecast_department(
        Forecasts(inputs).refined(), segment="0200", cycle_label="2001/05")


@QUERIES.query("""
    SELECT 'refined_forecast_enriched' AS tabela, count(*) AS linhas FROM ox_refined
    UNION ALL SELECT 'demand_analytical_base', count(*) FROM ox_base""")
def report_counts(inputs: Inputs) -> DataFrame:
    return reports.report_counts({
        "refined_forecast_enriched": Forecasts(inputs).refined(),
        "demand_analytical_base": Closing(inputs).base()})


@QUERIES.query("""
    SELECT material, empresa, origem FROM fx_master ORDER BY material DESC, empresa DESC, origem DESC LIMIT 100""")
def report_latest(inputs: Inputs) -> DataFrame:
    return reports.report_latest(inputs.view("fx_master").select("material", "empresa", "origem"), 100)


@QUERIES.query("""
    SELECT s.* FROM fx_sales s WHERE data >= (SELECT m - INTERVAL 12 MONTH FROM ox_anchor)
      AND data < (SELECT m + INTERVAL 1 MONTH FROM ox_anchor)""")
def sales_window_export(inputs: Inputs) -> DataFrame:
    from partflow.operators.project import closed_month_window

    return closed_month_window(inputs.view("fx_sales"), "data", 13, half_open=True)


@QUERIES.query("""
    SELECT strftime(data, '%Y-%m') AS mes, count(*) AS linhas, CAST(sum(quantidade) AS DECIMAL(38,3)) AS quantidade
    FROM fx_sales WHERE data >= (SELECT m - INTERVAL 12 MONTH FROM ox_anchor) GROUP BY 1""")
def sales_window_check(inputs: Inputs) -> DataFrame:
    from partflow.operators.aggregate import group_expr

    return group_expr(
        sales_window_export(inputs), {"mes": F.date_format("data", "yyyy-MM")},
        linhas=F.count(F.lit(1)), quantidade=F.sum("quantidade").cast("decimal(38,3)"))

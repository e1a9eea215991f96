"""Reports as SQL table functions with named arguments.

``register_reports`` creates temporary functions over the views of a session, so a report is a query like any other:
``SELECT * FROM demand_by_origin(since => DATE '2000-09-01', items => array('M10'))``. An argument that is NULL, as all
are unless given, restricts nothing. Spark puts the body of a function into the plan of the query that calls it, so filters
and columns of the caller reach the scans, and constant arguments leave no trace of the tests for NULL.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from partflow.config import REFINED_LAGS
from partflow.functions.labels import ORIGIN_LABELS
from partflow.plans.reports import COCKPIT_BUYERS, COCKPIT_ORIGIN

_BUYERS = ", ".join(f"'{buyer}'" for buyer in COCKPIT_BUYERS)
_ORIGIN = "CASE m.origem " + " ".join(f"WHEN '{code}' THEN '{name}'" for code, name in ORIGIN_LABELS.items()) + " ELSE m.origem END"

#: Materials of the cockpit with their number; an item counts once, under its smallest origin and buyer, with ``once``.
_MATERIALS = f"""
    SELECT empresa, item_principal_cadeia, if(once, f.origem, c.origem) AS origem,
      if(once, f.grupo_de_compradores, c.grupo_de_compradores) AS grupo_de_compradores, if(once, 1, n) AS n
    FROM (SELECT empresa, item_principal_cadeia, origem, grupo_de_compradores, count(*) AS n,
        min(struct(origem, grupo_de_compradores)) OVER (PARTITION BY empresa, item_principal_cadeia) AS f
      FROM {{view}} WHERE (org IS NULL OR empresa = org) AND (origem = '{COCKPIT_ORIGIN}' AND grupo_de_compradores IN ({_BUYERS})
        OR array_contains(items, item_principal_cadeia))
      GROUP BY empresa, item_principal_cadeia, origem, grupo_de_compradores) c
    WHERE NOT once OR struct(c.origem, c.grupo_de_compradores) <=> f"""

FUNCTIONS = {
    "demand_by_origin": f"""(since DATE DEFAULT NULL, org STRING DEFAULT NULL, items ARRAY<STRING> DEFAULT NULL, once BOOLEAN DEFAULT false)
        RETURNS TABLE (empresa STRING, origem STRING, descricao_origem STRING, grupo_de_compradores STRING, total_demanda BIGINT)
        RETURN SELECT m.empresa, m.origem, {_ORIGIN}, m.grupo_de_compradores, sum(d.q * m.n)
        FROM (SELECT organizacao_vendas, item_principal_cadeia, sum(quantidade) AS q FROM {{base}}
          WHERE since IS NULL OR data_ordem >= since GROUP BY 1, 2) d
        JOIN ({_MATERIALS}) m ON m.empresa = d.organizacao_vendas AND m.item_principal_cadeia = d.item_principal_cadeia
        GROUP BY m.empresa, m.origem, m.grupo_de_compradores""",
    "forecast_by_origin": f"""(first DATE DEFAULT NULL, last DATE DEFAULT NULL, org STRING DEFAULT NULL,
          items ARRAY<STRING> DEFAULT NULL, once BOOLEAN DEFAULT false, cycle DATE DEFAULT NULL)
        RETURNS TABLE (empresa STRING, origem STRING, descricao_origem STRING, grupo_de_compradores STRING, total_forecast DOUBLE)
        RETURN SELECT m.empresa, m.origem, {_ORIGIN}, m.grupo_de_compradores, round(sum(d.q * m.n), 0)
        FROM (SELECT segment, material, sum(forecast_qty) AS q FROM {{forecast}}
          WHERE forecast_cycle = coalesce(cycle, (SELECT max(forecast_cycle) FROM {{forecast}}))
            AND (first IS NULL OR forecast_month >= first) AND (last IS NULL OR forecast_month <= last) GROUP BY 1, 2) d
        JOIN ({_MATERIALS}) m ON m.empresa = d.segment AND m.item_principal_cadeia = d.material
        GROUP BY m.empresa, m.origem, m.grupo_de_compradores""",
    "actual_and_forecast": f"""(since DATE DEFAULT NULL, before DATE DEFAULT NULL, item STRING DEFAULT NULL, cycles ARRAY<DATE> DEFAULT NULL)
        RETURNS TABLE (cycle DATE, mes DATE, valor DOUBLE)
        RETURN SELECT CAST(NULL AS DATE), CAST(date_trunc('MONTH', data_ordem) AS DATE), CAST(sum(quantidade) AS DOUBLE) FROM {{base}}
        WHERE (item IS NULL OR item_principal_cadeia = item) AND (since IS NULL OR data_ordem >= since)
          AND (before IS NULL OR data_ordem < before) GROUP BY 2
        UNION ALL SELECT forecast_cycle, forecast_month, sum(forecast_qty) FROM {{forecast}}
        WHERE (item IS NULL OR main_material = item) AND lag < {REFINED_LAGS}
          AND (cycles IS NULL OR array_contains(cycles, forecast_cycle)) GROUP BY 1, 2""",
}


def register_reports(spark: SparkSession, base: str = "demand_base", view: str = "material_view",
                     forecast: str = "refined_forecast") -> None:
    """Creates the functions over three views: the analytical base, the material view and the refined forecast."""
    for name, body in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name} {body.format(base=base, view=view, forecast=forecast)}")

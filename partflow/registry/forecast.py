"""Forecast queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partflow.config import HORIZON
from partflow.functions.dates import label_of, shift_month
from partflow.operators.quality import lag_profile as profile
from partflow.operators.quality import reconcile as reconciled
from partflow.plans import forecast, materials
from partflow.registry.base import Family
from partflow.registry.demand import Closing
from partflow.registry.fixtures import ANCHOR, CYCLES, Inputs
from partflow.runs import run_forecast
from partflow.session import scratch_path
from partflow.sinks.tables import TableFolder

QUERIES = Family()
CYCLE = shift_month(ANCHOR, -3)
assert CYCLES[-1] == f"{CYCLE}"


class Forecasts:
    def __init__(self, inputs: Inputs):
        wide = inputs.view("fx_forecast")
        self.raw = forecast.forecast_typed(
            wide.toDF(*[c.replace("h", "n+", 1) if c[0] == "h" else c for c in wide.columns]))
        self.chain = materials.material_chain(inputs.view("fx_master"))

    def refined(self) -> DataFrame:
        return forecast.forecast_refined(self.raw, self.chain)


_TYPED = ", ".join(
    f"CAST(CASE WHEN regexp_matches(h{i}, '^\\s*$') THEN '0' ELSE h{i} END AS DOUBLE) AS \"n+{i}\"" for i in range(36))


@QUERIES.query(f"SELECT CAST(forecast_cycle AS DATE) AS forecast_cycle, * EXCLUDE (forecast_cycle, {', '.join(f'h{i}' for i in range(36))}), {_TYPED} FROM fx_forecast")
def forecast_typed(inputs: Inputs) -> DataFrame:
    return Forecasts(inputs).raw


@QUERIES.query("SELECT * FROM ox_refined")
def forecast_refined(inputs: Inputs) -> DataFrame:
    return Forecasts(inputs).refined()


@QUERIES.query("SELECT * FROM ox_refined WHERE _raw_load_id NOT IN ('load-0', 'load-1', 'load-2')")
def anti_unprocessed(inputs: Inputs) -> DataFrame:
    f = Forecasts(inputs)
    done = f.raw.where(F.col("forecast_cycle") < "2000-12-01").select(
        F.col("_load_id").alias("_raw_load_id"))
    return forecast.forecast_refined(f.raw, f.chain, done)


@QUERIES.query("""SELECT forecast_cycle, segment, CAST(lag AS INTEGER) AS lag, count(*) AS linhas,
      count(forecast_qty) AS preenchidas, sum(forecast_qty) AS total FROM ox_refined_all GROUP BY ALL""")
def unpivot_horizon(inputs: Inputs) -> DataFrame:
    """All 36 horizons in long form, summed up for the comparison."""
    long = forecast.unpivot_horizon(Forecasts(inputs).raw, ["forecast_cycle", "segment"], HORIZON)
    return long.groupBy("forecast_cycle", "segment", "lag").agg(
        F.count(F.lit(1)).alias("linhas"), F.count("forecast_qty").alias("preenchidas"),
        F.sum("forecast_qty").alias("total"))


def prev_sql(by_channel: bool) -> str:
    columns = ", ".join(
        f"sum(CAST(CASE WHEN regexp_matches(h{i}, '^\\s*$') THEN '0' ELSE h{i} END AS DOUBLE)) AS \"{label_of(shift_month(CYCLE, i))}\""
        for i in range(1, 36))
    channel = "CASE market WHEN 'Domestic' THEN 'Doméstico' WHEN 'Export' THEN 'Exportação' ELSE market END AS canal," if by_channel else ""
    return f"""SELECT replace(left(forecast_cycle, 7), '-', '/') AS ciclo,
        CASE segment WHEN '0200' THEN '2W - Motos' WHEN '0500' THEN '4W - Automóveis' ELSE segment END AS segmento,
        {channel} coalesce(c.item_principal_cadeia, main_material) AS item_principal_cadeia, forecast_classification, {columns}
        FROM fx_forecast f LEFT JOIN ox_chain c ON f.segment = c.empresa AND f.main_material = c.material
        WHERE forecast_cycle = (SELECT max(forecast_cycle) FROM fx_forecast) GROUP BY ALL"""


@QUERIES.query(prev_sql(True))
def forecast_prev(inputs: Inputs) -> DataFrame:
    f = Forecasts(inputs)
    return forecast.forecast_prev(f.raw, f.chain)


@QUERIES.query(prev_sql(False))
def forecast_prev_no_channel(inputs: Inputs) -> DataFrame:
    f = Forecasts(inputs)
    return forecast.forecast_prev(f.raw, f.chain, by_channel=False)


_ACCURACY = """
    SELECT f.segment, f.market, f.main_material, f.forecast_month, f.forecast_qty, d.quantidade AS actual_qty
    FROM (SELECT segment, market, main_material, forecast_month, sum(forecast_qty) AS forecast_qty FROM ox_refined
      WHERE lag = 3 GROUP BY ALL) f
    JOIN (SELECT organizacao_vendas, canal_distribuicao, item_principal_cadeia,
        CAST(date_trunc('month', data_ordem) AS DATE) AS mes, CAST(sum(quantidade) AS BIGINT) AS quantidade
      FROM ox_base GROUP BY ALL) d
      ON f.segment = d.organizacao_vendas AND f.main_material = d.item_principal_cadeia AND f.forecast_month = d.mes
      AND f.market = CASE d.canal_distribuicao WHEN '01' THEN 'Domestic' WHEN '02' THEN 'Export' ELSE d.canal_distribuicao END"""


@QUERIES.query(_ACCURACY)
def forecast_accuracy(inputs: Inputs) -> DataFrame:
    return forecast.forecast_accuracy(Forecasts(inputs).refined(), Closing(inputs).lean_base())


@QUERIES.query(f"""
    SELECT *, forecast_qty - actual_qty AS error, abs(forecast_qty - actual_qty) AS abs_error,
      CASE WHEN actual_qty <> 0 THEN abs(forecast_qty - actual_qty) / abs(actual_qty) END AS abs_pct_error,
      CASE WHEN actual_qty <> 0 THEN 1 - abs(forecast_qty - actual_qty) / abs(actual_qty) END AS accuracy
    FROM ({_ACCURACY})""")
def forecast_metrics(inputs: Inputs) -> DataFrame:
    return forecast.forecast_metrics(
        forecast.forecast_accuracy(Forecasts(inputs).refined(), Closing(inputs).lean_base()))


_GROUPS = "SELECT forecast_cycle, segment, material, forecast_month, sum(forecast_qty) AS forecast_qty FROM ox_refined GROUP BY ALL"
_IN_WINDOW = "forecast_cycle >= (SELECT max(forecast_cycle) - INTERVAL 6 MONTH FROM ox_refined)"


@QUERIES.query(f"SELECT * FROM ({_GROUPS}) WHERE {_IN_WINDOW} AND forecast_qty >= -1e-6")
def forecast_export(inputs: Inputs) -> DataFrame:
    f = Forecasts(inputs)
    refined = f.refined()
    return forecast.forecast_export(refined, latest=forecast.latest_refined_cycle(refined, f.raw))


@QUERIES.query(f"SELECT * FROM ({_GROUPS}) WHERE forecast_qty < -1e-6")
def forecast_negatives(inputs: Inputs) -> DataFrame:
    return forecast.forecast_negatives(Forecasts(inputs).refined())


@QUERIES.query(f"""
    SELECT r.forecast_cycle, r.segment, r.material, r.forecast_month, g.forecast_qty AS forecast_qty_total_grupo,
      r.lag, r.forecast_type, r.department, r.market, r.main_material, r.forecast_classification, r.forecast_qty
    FROM ox_refined r JOIN ({_GROUPS}) g ON r.forecast_cycle = g.forecast_cycle AND r.segment = g.segment
      AND r.material = g.material AND r.forecast_month = g.forecast_month
    WHERE g.forecast_qty < -1e-6""")
def forecast_negative_detail(inputs: Inputs) -> DataFrame:
    return forecast.forecast_negative_detail(Forecasts(inputs).refined())


@QUERIES.query(f"""
    SELECT * FROM (WITH g AS (SELECT * FROM ({_GROUPS}) WHERE {_IN_WINDOW})
    SELECT s.forecast_cycle, s.rows_source, s.qty_source, k.rows_kept, k.qty_kept,
      coalesce(n.rows_removed, 0) AS rows_removed, coalesce(n.qty_removed, 0) AS qty_removed,
      round(s.qty_source - k.qty_kept - coalesce(n.qty_removed, 0), 3) AS diff_qty
    FROM (SELECT forecast_cycle, count(*) AS rows_source, sum(forecast_qty) AS qty_source FROM ox_refined
        WHERE {_IN_WINDOW} GROUP BY 1) s
    FULL JOIN (SELECT forecast_cycle, count(*) AS rows_kept, sum(forecast_qty) AS qty_kept FROM g
        WHERE forecast_qty >= -1e-6 GROUP BY 1) k ON s.forecast_cycle = k.forecast_cycle
    LEFT JOIN (SELECT forecast_cycle, count(*) AS rows_removed, sum(forecast_qty) AS qty_removed FROM g
        WHERE forecast_qty < -1e-6 GROUP BY 1) n ON s.forecast_cycle = n.forecast_cycle)""")
def reconcile(inputs: Inputs) -> DataFrame:
    f = Forecasts(inputs)
    refined = f.refined()
    window = forecast.cycle_window(refined, forecast.latest_refined_cycle(refined, f.raw), 7)
    groups = forecast.forecast_groups(window)
    kept = groups.where(F.col("forecast_qty") >= forecast.NEGATIVE_LIMIT)
    removed = groups.where(F.col("forecast_qty") < forecast.NEGATIVE_LIMIT)
    return reconciled(window, kept, removed, "forecast_cycle", "forecast_qty")


@QUERIES.query("SELECT CAST(lag AS INTEGER) AS lag, count(*) AS qtd_linhas, sum(forecast_qty) AS total_qty FROM ox_refined GROUP BY 1")
def lag_profile(inputs: Inputs) -> DataFrame:
    return profile(Forecasts(inputs).refined())


@QUERIES.query("SELECT *, CASE WHEN _raw_load_id IN ('load-0', 'load-1', 'load-2') THEN 'A' ELSE 'B' END AS _load_id FROM ox_refined")
def forecast_loads(inputs: Inputs) -> DataFrame:
    """The refined table after a run over three loads, one over all, and one that finds nothing new."""
    f, root = Forecasts(inputs), scratch_path(inputs.spark, "forecast")
    first = f.raw.where(F.col("_load_id").isin("load-0", "load-1", "load-2"))
    now = F.lit("2001-09-01 00:00:00").cast("timestamp")
    for raw, load_id in ((first, "A"), (f.raw, "B"), (f.raw, "C")):
        run_forecast(inputs.spark, root, raw, f.chain, load_id, now, "me")
    table = TableFolder(inputs.spark, f"{root}/refined_forecast_enriched", {"_raw_load_id": "string"}).read()
    return table.select(*f.refined().columns, "_load_id")

"""The monthly runs end to end."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from partflow import runs
from partflow.config import FORECAST_IDS, HORIZON, REFINED_LAGS
from partflow.operators.quality import GateError, gate_scd2_state
from partflow.plans import forecast, history, materials
from partflow.registry.demand import Closing
from partflow.registry.fixtures import Inputs
from partflow.registry.forecast import Forecasts
from partflow.sinks.tables import HistoryFolder, TableFolder


@pytest.fixture(scope="module")
def closing(spark, data):
    return Closing(Inputs(spark, data))


def test_closing_writes_all_tables(spark, closing, tmp_path):
    names = runs.run_closing(spark, str(tmp_path), closing.sales, closing.chain, closing.area)
    assert len(names) == len(set(names)) == 21  # nine views and the distribution per segment, one ABC curve
    wide = TableFolder(spark, f"{tmp_path}/refined_demand_fechada_HDA").read()
    assert len(wide.columns) == 63 and {r.sheet for r in wide.select("sheet").distinct().collect()} == {
        "TTL", "0203", "0209", "0232"}
    assert TableFolder(spark, f"{tmp_path}/refined_demand_mi_HAB").read().where("sheet <> 'TTL'").isEmpty()
    assert TableFolder(spark, f"{tmp_path}/refined_demand_distribuicao_HAB").read().columns[3] == "DMD_0503"
    runs.run_delivery(spark, str(tmp_path), ["refined_demand_zpug_HDA"], f"{tmp_path}/out")
    assert spark.read.option("header", True).csv(f"{tmp_path}/out/refined_demand_zpug_HDA").count() == TableFolder(
        spark, f"{tmp_path}/refined_demand_zpug_HDA").read().count()


def test_closing_as_single_tables(spark, closing, tmp_path):
    names = runs.run_closing(spark, str(tmp_path), closing.sales, closing.chain, closing.area, "tabela_unica",
                             closing.anchor)
    assert len(names) == 11
    one = TableFolder(spark, f"{tmp_path}/refined_demand_linha", {"segmento": "string"}).read()
    assert {r.segmento for r in one.select("segmento").distinct().collect()} == {"HDA", "HAB"}


def test_closing_refuses_repeated_keys(spark, closing, tmp_path):
    twice = closing.chain.unionByName(closing.chain.limit(1))
    with pytest.raises(GateError, match="duplicate"):
        runs.run_closing(spark, str(tmp_path), closing.sales, twice, closing.area, anchor=closing.anchor)


def test_history_folder(spark, data, tmp_path):
    master = Inputs(spark, data).view("fx_master")
    folder = HistoryFolder(spark, str(tmp_path / "h"))
    history.load_history_folder(folder, master, date(2001, 6, 1))
    second = master.where("CAST(substring(material, 2, 2) AS STRING) <> '10'").withColumn(
        "cadeia", F.when(F.col("material").endswith("7"), F.lit("new")).otherwise(F.col("cadeia")))
    history.load_history_folder(folder, second, date(2001, 7, 1))
    history.load_history_folder(folder, master, date(2001, 8, 1))
    stored = folder.read()
    in_memory = history.load_history(None, master, date(2001, 6, 1))
    for reference, snapshot in ((date(2001, 7, 1), second), (date(2001, 8, 1), master)):
        in_memory = history.load_history(in_memory, snapshot, reference)
    assert sorted(map(repr, stored.collect())) == sorted(map(repr, in_memory.select(*stored.columns).collect()))
    assert gate_scd2_state(stored, ["empresa", "material"]).isEmpty()
    for month in (7, 8):
        with pytest.raises(GateError, match="chronology"):
            history.load_history_folder(folder, master, date(2001, month, 1))


def test_broken_load_has_no_effect(spark, data, tmp_path):
    master = Inputs(spark, data).view("fx_master")
    folder = HistoryFolder(spark, str(tmp_path / "h"))
    history.load_history_folder(folder, master, date(2001, 6, 1))
    before = folder.read().count()
    # As if a load had stopped after the ended versions and before the current ones.
    folder.read().where("is_current").write.parquet(f"{tmp_path}/h/closed/month=200107")
    assert folder.read().count() == before


def test_master_and_forecast_runs(spark, data, tmp_path):
    inputs = Inputs(spark, data)
    stock = inputs.view("fx_stock").dropDuplicates(["empresa", "material", "centro"]).drop("tipo_de_material")
    master = inputs.view("fx_master").drop("centro").join(stock, ["empresa", "material"]).withColumn(
        "reference_date", F.lit("2001-08-01").cast("date"))
    assert runs.run_master(spark, str(tmp_path), master, None) == date(2001, 8, 1)
    with pytest.raises(GateError):
        runs.run_master(spark, str(tmp_path), master, None)
    assert runs.run_master(spark, str(tmp_path), master.where("false")) is None
    forecasts = Forecasts(inputs)
    now = F.lit("2001-09-01 00:00:00").cast("timestamp")
    first = forecasts.raw.where("forecast_cycle < DATE '2001-01-01'")
    chain = materials.material_chain(inputs.view("fx_master"))
    runs.run_forecast(spark, str(tmp_path), first, chain, "A", now, "me")
    runs.run_forecast(spark, str(tmp_path), forecasts.raw, chain, "B", now, "me")
    runs.run_forecast(spark, str(tmp_path), forecasts.raw, chain, "C", now, "me")
    table = TableFolder(spark, f"{tmp_path}/refined_forecast_enriched").read()
    assert {r._load_id for r in table.select("_load_id").distinct().collect()} == {"A", "B"}
    assert table.count() == forecasts.refined().count()


def test_forecast_run_moves_wide_rows(spark, tmp_path, monkeypatch):
    ids = ("2001-05-01", "Domestic - Parts", "Judgment", "0200", "Domestic")
    names = [*FORECAST_IDS, *HORIZON, "_load_id"]
    raw = spark.createDataFrame(
        [(*ids, f"M{n}", "Supply", *[float(n + i) for i in range(len(HORIZON))], None if n % 5 == 0 else f"load-{n % 3}") for n in range(60)]
        + [(*ids[:2], "Enrich", *ids[3:], "M0", None, *[0.0] * len(HORIZON), "load-1")] * 2, names)
    raw = raw.withColumn("forecast_cycle", F.col("forecast_cycle").cast("date"))
    chain = spark.createDataFrame([("0200", f"M{n}", f"M{n % 7}") for n in range(40)], "empresa string, material string, item_principal_cadeia string")
    plans, write = [], TableFolder._write

    def seen(self, df, *args, **options):
        plans.append((df._jdf.queryExecution().executedPlan().toString(), args))
        write(self, df, *args, **options)

    monkeypatch.setattr(TableFolder, "_write", seen)
    runs.run_forecast(spark, str(tmp_path), raw, chain, "A", F.lit("2001-09-01 00:00:00").cast("timestamp"), "me")
    plan, (_, _, gathered) = plans[0]
    # The shuffle lies below the unpivot, and the writer adds none.
    assert plan.index("Generate explode") < plan.index("REBALANCE_PARTITIONS_BY_COL") and gathered
    refined = forecast.forecast_refined(raw, chain)
    stored = TableFolder(spark, f"{tmp_path}/refined_forecast_enriched", {"_raw_load_id": "string"}).read().select(*refined.columns)
    assert sorted(map(repr, stored.collect())) == sorted(map(repr, refined.collect())) and refined.count() == 60 * REFINED_LAGS

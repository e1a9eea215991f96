"""The monthly runs: which plans feed which tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from partflow.config import BOTH, DEMAND_VIEWS, MOTORCYCLES, SEGMENTS
from partflow.operators.aggregate import max_of, union_all
from partflow.operators.quality import enforce, gate_duplicates, gate_reference_date
from partflow.plans import demand, enrich, forecast, history, inventory, materials, supersession
from partflow.plans.monthly import MonthSums
from partflow.sinks.export import export_csv, export_sheets
from partflow.sinks.tables import NULL_PARTITION, HistoryFolder, TableFolder, publish_segments

PREFIX = "refined_demand_"


def run_closing(spark: SparkSession, root: str, sales: DataFrame, chain: DataFrame, area: DataFrame,
                mode: str = "multi_tabela", anchor: date | None = None,
                orgs: Sequence[str] = BOTH) -> list[str]:
    """Writes all demand tables of a closing; returns their names.

    The sales are read three times: for the monthly sums of all views, for the urgent
    orders by customer and, without an anchor, for the latest month.
    """
    enforce(gate_duplicates(chain, ["empresa", "material"]),
            gate_duplicates(area, list(enrich.AREA_KEYS.values())))
    anchor = anchor or max_of(sales, "data")
    urgent = DEMAND_VIEWS["zpug_cliente"]
    return publish_closing(
        spark, root, enrich.demand_cube(sales, chain, area, anchor),
        enrich.customer_cube(sales, chain, anchor, urgent.months, urgent.only_type), anchor, mode, orgs)


def run_closing_of_sums(spark: SparkSession, root: str, sums: MonthSums, chain: DataFrame, area: DataFrame,
                        mode: str = "multi_tabela", anchor: date | None = None,
                        orgs: Sequence[str] = BOTH) -> list[str]:
    """The same closing from stored monthly sums: only months with changed sales are summed anew."""
    enforce(gate_duplicates(chain, ["empresa", "material"]),
            gate_duplicates(area, list(enrich.AREA_KEYS.values())))
    sums.update()
    anchor = anchor or sums.anchor()
    urgent = DEMAND_VIEWS["zpug_cliente"]
    return publish_closing(
        spark, root, enrich.cube_of_sums(sums.read(anchor, max(v.months for v in DEMAND_VIEWS.values())), chain, area),
        enrich.customer_cube_of_sums(sums.read(anchor, urgent.months), chain, urgent.only_type), anchor, mode, orgs)


def publish_closing(spark: SparkSession, root: str, cube: DataFrame, customers: DataFrame, anchor: date,
                    mode: str, orgs: Sequence[str]) -> list[str]:
    """Stores the cube and writes the tables of all views."""
    sums = TableFolder(spark, f"{root}/_cube")
    sums.replace(cube)
    cube = sums.read()
    views = [v for v in DEMAND_VIEWS.values() if not v.by_customer]
    measures = TableFolder(spark, f"{root}/_measures", {"grain": "string"})
    measures.replace(demand.demand_measures(cube, views, orgs))
    names = []

    def publish(key: str, table: DataFrame, segments: Sequence[str] = orgs) -> None:
        names.extend(publish_segments(spark, root, f"{PREFIX}{key}", table, mode, segments))

    for view in views:
        rows = demand.view_rows(measures.read(), view)
        publish(view.key, demand.view_table(rows, view, anchor))
        if view.key == "linha":
            ranked = rows.where(F.col("org_vendas") == MOTORCYCLES)
            publish("linha_abc", demand.abc_curve(ranked, anchor), [MOTORCYCLES])
    urgent = DEMAND_VIEWS["zpug_cliente"]
    publish(urgent.key, demand.urgent_by_customer(customers, anchor, orgs))
    shares = {org: demand.distribution(cube, org, anchor) for org in orgs}
    if mode == "tabela_unica":
        publish("distribuicao", union_all([
            df.withColumn("org_vendas", F.lit(org)) for org, df in shares.items()]))
    else:
        for org, df in shares.items():
            names.append(f"{PREFIX}distribuicao_{SEGMENTS[org].tag}")
            TableFolder(spark, f"{root}/{names[-1]}").replace(df)
    return names


def run_delivery(spark: SparkSession, root: str, names: Sequence[str], target: str,
                 sheets: bool = True, fit_worksheet: bool = False) -> dict[str, DataFrame]:
    """Delivers the tables of a closing as sheet folders or as plain CSV; returns their sheet names."""
    listed = {}
    for name in names:
        table = TableFolder(spark, f"{root}/{name}").read()
        if sheets:
            order = ("rank",) if "rank" in table.columns else ()
            listed[name] = export_sheets(table, f"{target}/{name}", order=order, fit_worksheet=fit_worksheet)
        else:
            export_csv(table, f"{target}/{name}.csv")
    return listed


def run_master(spark: SparkSession, root: str, master: DataFrame, bom: DataFrame | None = None,
               audit: Mapping[str, Column] | None = None) -> date | None:
    """Everything that follows from a loaded master: chain, inventory, history, supersession.

    Returns the reference month, None for an empty master.
    """
    enforce(gate_reference_date(master))
    first = master.select("reference_date").first()
    if first is None:
        return None
    reference = first[0].replace(day=1)
    TableFolder(spark, f"{root}/material_cadeia").replace(materials.material_chain(master))
    TableFolder(spark, f"{root}/material_inventory_history", {
        "reference_date": "date", "empresa": "string", "centro": "string",
    }).replace_scopes(inventory.inventory_snapshot(master, reference))
    history.load_history_folder(
        HistoryFolder(spark, f"{root}/material_spec_changes"), master, reference, audit)
    if bom is not None:
        edges = supersession.supersession_edges(bom, master)
        TableFolder(spark, f"{root}/material_de_para").replace(supersession.supersession_map(master, edges))
    return reference


def run_forecast(spark: SparkSession, root: str, raw: DataFrame, chain: DataFrame, load_id: str,
                 now: Column, user: str) -> None:
    """Takes the loads of the raw forecast that are not refined yet into the refined table.

    Its folders are named by load, so the finished loads are known without reading a row of it, and
    the scan of the raw forecast leaves them out.
    """
    table = TableFolder(spark, f"{root}/refined_forecast_enriched", {"_raw_load_id": "string"})
    finished = sorted(table.partitions("_raw_load_id"))
    done = F.coalesce(F.col("_load_id").isin(finished), F.lit(NULL_PARTITION in finished))
    new = raw.where(~done) if finished else raw
    refined = forecast.forecast_refined(new, chain, gathered=True)
    if not new.isEmpty():
        table.append(forecast.publish_refined(refined, load_id, now, user), gathered=True)

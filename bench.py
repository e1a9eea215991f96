"""Times the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from partflow.config import DEMAND_VIEWS, SEGMENTS, TOTAL_SHEET
from partflow.functions.dates import month_label, shift_month
from partflow.registry import all_queries
from partflow.registry.demand import Closing
from partflow.registry.fixtures import Inputs
from partflow.session import build_session
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

HEADLINES = (
    "demand_closed", "demand_all_views", "demand_abc", "demand_distribution", "demand_urgent_customer",
    "demand_base", "upsert", "dedupe_latest", "scd2_apply", "replace_scopes", "inventory_snapshot",
    "sales_parse", "forecast_refined", "forecast_prev", "forecast_accuracy", "forecast_negative_detail",
    "supersession_map", "calendar_dim", "report_center_adjusted", "report_demand_origin",
    "report_actual_vs_forecast", "gate_files", "gate_conflict", "running_share", "stream_upsert",
)


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def naive_closed(inputs: Inputs, count: bool) -> None:
    """The closed demand as a loop over sheets: join, discover the months, pivot, run, and count where asked."""
    closing = Closing(inputs)
    base = closing.sales.where(F.col("data") >= F.lit(shift_month(closing.anchor, -59)))
    area = closing.area.select("cliente", "orgv", "cdst", "sa", F.col("cen").alias("centro_original"))
    chain = closing.chain.withColumnRenamed("material", "m")
    rows = base.join(chain, (base.material == chain.m) & (base.org_vendas == chain.empresa), "left").join(
        area, (F.col("emissor_da_ordem").cast("string") == F.col("cliente")) & (F.col("org_vendas") == F.col("orgv"))
        & (F.col("canal_dist") == F.col("cdst")) & (F.col("setor_ativ") == F.col("sa")), "left"
    ).withColumn("item", F.coalesce("item_principal_cadeia", "material"))
    for segment in SEGMENTS.values():
        for sheet in (TOTAL_SHEET, *segment.centers):
            part = rows.where(F.col("org_vendas") == segment.org)
            if sheet != TOTAL_SHEET:
                part = part.where(F.col("centro_original") == sheet)
            wide = part.withColumn("mes", month_label(F.col("data"))).groupBy("item").pivot("mes").agg(
                F.sum("quantidade")).fillna(0)
            run(wide)
            if count:
                wide.count()


def plain_window(inputs: Inputs) -> DataFrame:
    """Ranks and running sums with one ordered window per group."""
    counts = inputs.view("fx_sales").groupBy("org_vendas", "material").agg(F.count(F.lit(1)).alias("linhas"))
    group = Window.partitionBy("org_vendas")
    order = group.orderBy(F.col("linhas").desc(), "material")
    return counts.select("*", F.row_number().over(order).alias("rank"), F.sum("linhas").over(group).alias("total"), F.sum(
        "linhas").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("running"))


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    known = all_queries()
    # Warm-up for the JIT and the generated code, on the smallest tables where they are there.
    small = os.path.join(os.path.dirname(folder.rstrip("/")), "sf0.001")
    for name in HEADLINES:
        run(known[name].run(spark, small if os.path.isdir(small) else folder))
    run(known["demand_closed"].run(spark, folder))
    times = {}
    for name in HEADLINES:
        start = time.perf_counter()
        run(known[name].run(spark, folder))
        times[name] = round(time.perf_counter() - start, 3)
    baseline = {}
    for name, count in (("demand_closed_per_sheet_loop", False), ("demand_closed_per_sheet_loop_with_count", True)):
        start = time.perf_counter()
        naive_closed(Inputs(spark, folder), count)
        baseline[name] = round(time.perf_counter() - start, 3)
    start = time.perf_counter()
    run(plain_window(Inputs(spark, folder)))
    baseline["running_share_plain_window"] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": folder.rstrip("/").rsplit("/", 1)[-1].removeprefix("sf"),
        "baseline": baseline,
        "views": len(DEMAND_VIEWS),
    }))
    spark.stop()


if __name__ == "__main__":
    main()

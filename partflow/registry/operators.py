"""Queries of single operators: windows, joins, aggregates, set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partflow.functions.dates import label_of, last_months
from partflow.operators import aggregate, joins, project, running
from partflow.plans import customers, enrich, materials
from partflow.registry.base import Family
from partflow.registry.fixtures import ANCHOR, Inputs
from partflow.session import scratch_path

QUERIES = Family()


@QUERIES.query("SELECT s.* FROM fx_sales s WHERE data >= (SELECT m - INTERVAL 11 MONTH FROM ox_anchor)")
def closed_window(inputs: Inputs) -> DataFrame:
    return project.closed_month_window(inputs.view("fx_sales"), "data", 12)


@QUERIES.query("""SELECT * FROM fx_sales WHERE org_vendas = '0500' AND canal_dist = '02' AND tipo_ov <> 'ZESP'""")
def demand_slice(inputs: Inputs) -> DataFrame:
    return project.demand_slice(inputs.view("fx_sales"), "0500", "02", exclude_type="ZESP")


@QUERIES.query("""SELECT empresa, material, grupo_de_compradores FROM fx_master
    WHERE grupo_de_compradores NOT IN ('040', '054') AND tipo_de_material IN ('ZHAW', 'ZFER', 'ZRO1')""")
def in_domain(inputs: Inputs) -> DataFrame:
    rows = project.in_domain(inputs.view("fx_master"), "grupo_de_compradores", ["040", "054"], negate=True)
    return project.in_domain(rows, "tipo_de_material", ["ZHAW", "ZFER", "ZRO1"]).select(
        "empresa", "material", "grupo_de_compradores")


@QUERIES.query("""SELECT empresa, material FROM fx_master
    WHERE coalesce(trim(item_principal_cadeia), '') = '' OR coalesce(trim(cadeia), '') = ''""")
def invalid_keys(inputs: Inputs) -> DataFrame:
    return project.invalid_keys(inputs.view("fx_master"), ["item_principal_cadeia", "cadeia"]).select(
        "empresa", "material")


@QUERIES.query("""SELECT empresa AS company, material, CAST(prazo_entrega_prevista_lead_time_firme AS INTEGER) AS lead_time
    FROM fx_master""")
def apply_mapping(inputs: Inputs) -> DataFrame:
    return project.apply_mapping(inputs.view("fx_master"), {
        "empresa": ("company", None), "material": ("material", "string"),
        "prazo_entrega_prevista_lead_time_firme": ("lead_time", "int")})


@QUERIES.query("""SELECT material, empresa, centro FROM fx_master ORDER BY material, empresa LIMIT 20""")
def head_by(inputs: Inputs) -> DataFrame:
    rows = inputs.view("fx_master").select("material", "empresa", "centro")
    return project.head_by(rows, [F.col("material"), F.col("empresa")], 20)


@QUERIES.query("SELECT DISTINCT org_vendas, material FROM fx_sales")
def distinct_pairs(inputs: Inputs) -> DataFrame:
    return aggregate.distinct_on(inputs.view("fx_sales").select("org_vendas", "material"))


@QUERIES.query("""
    SELECT 'TTL' AS sheet, org_vendas, material, CAST(sum(quantidade) AS DECIMAL(38,3)) AS quantidade, count(*) AS linhas
    FROM fx_sales GROUP BY 2, 3
    UNION ALL SELECT centro, org_vendas, material, CAST(sum(quantidade) AS DECIMAL(38,3)), count(*)
    FROM fx_sales WHERE centro IS NOT NULL GROUP BY 1, 2, 3""")
def grouping_sets_center(inputs: Inputs) -> DataFrame:
    return aggregate.sum_with_total(
        inputs.view("fx_sales"), ["org_vendas", "material"], "centro",
        {"quantidade": F.sum("quantidade").cast("decimal(38,3)"), "linhas": F.count(F.lit(1))})


_TWELVE = last_months(ANCHOR, 12)


@QUERIES.query("""SELECT org_vendas, material, """ + ", ".join(
    f"CAST(trunc(coalesce(sum(quantidade) FILTER (WHERE date_trunc('month', data) = DATE '{m}'), 0)) AS INTEGER) AS \"{label_of(m)}\""
    for m in _TWELVE) + " FROM fx_sales GROUP BY 1, 2")
def pivot_months(inputs: Inputs) -> DataFrame:
    sums = aggregate.sum_by_month(inputs.view("fx_sales"), ["org_vendas", "material"], "data", "quantidade")
    return aggregate.pivot_months(sums, ["org_vendas", "material"], _TWELVE, "quantidade")


@QUERIES.query("""SELECT org_vendas, CAST(date_trunc('month', data) AS DATE) AS mes,
    CAST(sum(quantidade) AS DECIMAL(28,3)) AS quantidade FROM fx_sales GROUP BY 1, 2""")
def sum_by_month(inputs: Inputs) -> DataFrame:
    return aggregate.sum_by_month(inputs.view("fx_sales"), ["org_vendas"], "data", "quantidade")


@QUERIES.query("""SELECT org_vendas, material, CAST(date_trunc('month', data) AS DATE) AS mes, count(quantidade) AS linhas
    FROM fx_sales GROUP BY ALL""")
def count_lines(inputs: Inputs) -> DataFrame:
    return aggregate.lines_by_month(inputs.view("fx_sales"), ["org_vendas", "material"], "data", "quantidade")


@QUERIES.query("""SELECT material, CAST(sum(quantidade) FILTER (WHERE canal_dist = '01') AS DECIMAL(28,3)) AS "01",
    CAST(sum(quantidade) FILTER (WHERE canal_dist = '02') AS DECIMAL(28,3)) AS "02" FROM fx_sales GROUP BY 1""")
def static_pivot(inputs: Inputs) -> DataFrame:
    return aggregate.static_pivot(inputs.view("fx_sales"), ["material"], "canal_dist", ["01", "02"], "quantidade")


@QUERIES.query("""
    SELECT material, "01" AS "DMD_01", "02" AS "DMD_02",
      CASE WHEN "01" + "02" > 0 THEN CAST(round(CAST(CAST(CAST("01" AS DOUBLE) / ("01" + "02") * 100 AS VARCHAR) AS DECIMAL(38,18)), 2) AS DOUBLE) ELSE 0 END AS "%_01",
      CASE WHEN "01" + "02" > 0 THEN CAST(round(CAST(CAST(CAST("02" AS DOUBLE) / ("01" + "02") * 100 AS VARCHAR) AS DECIMAL(38,18)), 2) AS DOUBLE) ELSE 0 END AS "%_02"
    FROM (SELECT material, CAST(trunc(coalesce(sum(quantidade) FILTER (WHERE canal_dist = '01'), 0)) AS INTEGER) AS "01",
      CAST(trunc(coalesce(sum(quantidade) FILTER (WHERE canal_dist = '02'), 0)) AS INTEGER) AS "02"
      FROM fx_sales GROUP BY 1)""")
def share_columns(inputs: Inputs) -> DataFrame:
    wide = aggregate.static_pivot(
        inputs.view("fx_sales"), ["material"], "canal_dist", ["01", "02"], "quantidade", fill=0)
    whole = wide.select("material", F.col("`01`").cast("int").alias("01"), F.col("`02`").cast("int").alias("02"))
    return aggregate.row_shares(whole, ["01", "02"], value_prefix="DMD_")


_RANKED = """
    SELECT org_vendas, material, linhas, CAST(row_number() OVER w AS INTEGER) AS "rank",
      CAST(sum(linhas) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS running,
      CAST(sum(linhas) OVER (PARTITION BY org_vendas) AS BIGINT) AS total
    FROM (SELECT org_vendas, material, count(*) AS linhas FROM fx_sales GROUP BY 1, 2)
    WINDOW w AS (PARTITION BY org_vendas ORDER BY linhas DESC, material)"""


@QUERIES.query(_RANKED)
def running_share(inputs: Inputs) -> DataFrame:
    counts = inputs.view("fx_sales").groupBy("org_vendas", "material").agg(F.count(F.lit(1)).alias("linhas"))
    return running.ranked_totals(counts, ["org_vendas"], "linhas", ["material"])


@QUERIES.query(f"SELECT org_vendas, material, \"rank\" FROM ({_RANKED}) WHERE \"rank\" <= 25")
def rank_tiebreak(inputs: Inputs) -> DataFrame:
    return running_share(inputs).where("rank <= 25").select("org_vendas", "material", "rank")


@QUERIES.query("""
    SELECT tipo_ov, material, linhas,
      CAST(row_number() OVER w AS INTEGER) AS "rank", CAST(sum(linhas) OVER w AS BIGINT) AS running,
      CAST(sum(linhas) OVER (PARTITION BY tipo_ov) AS BIGINT) AS total
    FROM (SELECT tipo_ov, material, count(*) AS linhas FROM fx_sales GROUP BY 1, 2)
    WINDOW w AS (PARTITION BY tipo_ov ORDER BY linhas DESC, material ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def running_share_null(inputs: Inputs) -> DataFrame:
    """The order type is NULL for a fifth of the sales: a group like the others."""
    counts = inputs.view("fx_sales").groupBy("tipo_ov", "material").agg(F.count(F.lit(1)).alias("linhas"))
    return running.ranked_totals(counts, ["tipo_ov"], "linhas", ["material"])


@QUERIES.query("""
    SELECT tipo_ov, org_vendas, material, quantidade FROM fx_sales
    QUALIFY count(*) OVER (PARTITION BY tipo_ov, org_vendas, material) > 1""")
def fan_out_null(inputs: Inputs) -> DataFrame:
    rows = inputs.view("fx_sales").select("tipo_ov", "org_vendas", "material", "quantidade")
    return aggregate.fan_out_rows(rows, ["tipo_ov", "org_vendas", "material"])


@QUERIES.query("""
    SELECT tipo_ov, org_vendas, material, quantidade FROM fx_sales
    QUALIFY count(*) OVER (PARTITION BY tipo_ov, org_vendas, material) = 1""")
def one_to_one_null(inputs: Inputs) -> DataFrame:
    rows = inputs.view("fx_sales").select("tipo_ov", "org_vendas", "material", "quantidade")
    return aggregate.keep_one_to_one(rows, ["tipo_ov", "org_vendas", "material"])


@QUERIES.query("""
    SELECT numero_ov, item, material, quantidade FROM fx_sales
    QUALIFY count(*) OVER (PARTITION BY numero_ov, item) = 1""")
def one_to_one(inputs: Inputs) -> DataFrame:
    rows = inputs.view("fx_sales").select("numero_ov", "item", "material", "quantidade")
    return aggregate.keep_one_to_one(rows, ["numero_ov", "item"])


@QUERIES.query("""
    SELECT numero_ov, item, material, quantidade FROM fx_sales
    QUALIFY count(*) OVER (PARTITION BY numero_ov, item) > 1""")
def fan_out(inputs: Inputs) -> DataFrame:
    rows = inputs.view("fx_sales").select("numero_ov", "item", "material", "quantidade")
    return aggregate.fan_out_rows(rows, ["numero_ov", "item"])


@QUERIES.query("""
    SELECT s.numero_ov, s.item, s.material, coalesce(c.item_principal_cadeia, s.material) AS item_principal_cadeia,
      a.cen AS centro_original, k.razao_social, k.estado, k.pais
    FROM fx_sales s LEFT JOIN ox_chain c ON s.material = c.material AND s.org_vendas = c.empresa
    LEFT JOIN ox_area a ON CAST(s.emissor_da_ordem AS VARCHAR) = a.cliente AND s.org_vendas = a.orgv
      AND s.canal_dist = a.cdst AND s.setor_ativ = a.sa
    LEFT JOIN ox_customer k ON CAST(s.emissor_da_ordem AS VARCHAR) = k.cliente""")
def left_enrich(inputs: Inputs) -> DataFrame:
    rows = enrich.enrich_chain(inputs.view("fx_sales"), materials.material_chain(inputs.view("fx_master")))
    rows = enrich.enrich_area(rows, customers.customer_area(inputs.view("fx_area")))
    rows = enrich.enrich_customer(rows, customers.customer_master(inputs.view("fx_customer")))
    return rows.select("numero_ov", "item", "material", "item_principal_cadeia", "centro_original",
                       "razao_social", "estado", "pais")


@QUERIES.query("""
    SELECT coalesce(a.material, b.material) AS material, coalesce(a.domestic, 0) AS domestic, coalesce(b.exported, 0) AS exported
    FROM (SELECT material, count(*) AS domestic FROM fx_sales WHERE canal_dist = '01' AND tipo_ov = 'ZPUG' GROUP BY 1) a
    FULL JOIN (SELECT material, count(*) AS exported FROM fx_sales WHERE canal_dist = '02' AND tipo_ov = 'ZESP' GROUP BY 1) b
      ON a.material = b.material""")
def full_outer_fill(inputs: Inputs) -> DataFrame:
    rows = inputs.view("fx_sales")
    left = project.demand_slice(rows, channel="01", only_type="ZPUG").groupBy("material").agg(
        F.count(F.lit(1)).alias("domestic"))
    right = project.demand_slice(rows, channel="02", only_type="ZESP").groupBy("material").agg(
        F.count(F.lit(1)).alias("exported"))
    return joins.full_merge(left, right, ["material"])


@QUERIES.query("""
    SELECT a.org_vendas, a.mes, a.material, a.linhas AS urgentes, b.linhas AS iniciais FROM
      (SELECT org_vendas, CAST(date_trunc('month', data) AS DATE) AS mes, material, count(quantidade) AS linhas FROM fx_sales
        WHERE tipo_ov = 'ZPUG' GROUP BY ALL) a
    JOIN (SELECT org_vendas, CAST(date_trunc('month', data) AS DATE) AS mes, material, count(quantidade) AS linhas FROM fx_sales
        WHERE tipo_ov = 'ZESP' GROUP BY ALL) b USING (org_vendas, mes, material)""")
def inner_composite(inputs: Inputs) -> DataFrame:
    rows, keys = inputs.view("fx_sales"), ["org_vendas", "material"]
    urgent = aggregate.lines_by_month(project.demand_slice(rows, only_type="ZPUG"), keys, "data",
                                      "quantidade", name="urgentes")
    initial = aggregate.lines_by_month(project.demand_slice(rows, only_type="ZESP"), keys, "data",
                                       "quantidade", name="iniciais")
    return joins.join_on_keys(urgent, initial, [*keys, "mes"])


@QUERIES.query("SELECT * FROM fx_sales WHERE data = (SELECT max(data) FROM fx_sales)")
def scalar_max(inputs: Inputs) -> DataFrame:
    return joins.latest_only(inputs.view("fx_sales"), "data")


@QUERIES.query("""
    SELECT org_vendas, material, CAST(sum(quantidade) AS DOUBLE) AS quantidade, CAST(NULL AS BIGINT) AS clientes
    FROM fx_sales GROUP BY 1, 2
    UNION ALL SELECT org_vendas, material, NULL, count(DISTINCT emissor_da_ordem) FROM fx_sales GROUP BY 1, 2""")
def union_typed_nulls(inputs: Inputs) -> DataFrame:
    rows = inputs.view("fx_sales")
    sums = rows.groupBy("org_vendas", "material").agg(F.sum("quantidade").cast("double").alias("quantidade"))
    customers_of = aggregate.distinct_by(rows, ["org_vendas", "material"], "emissor_da_ordem", "clientes")
    return aggregate.union_all([sums, customers_of])


@QUERIES.query("""SELECT org_vendas, canal_dist, string_agg(DISTINCT setor_ativ, ',' ORDER BY setor_ativ) AS setores
    FROM fx_sales GROUP BY 1, 2""")
def collect_sorted(inputs: Inputs) -> DataFrame:
    arrays = aggregate.collect_sorted(
        inputs.view("fx_sales"), ["org_vendas", "canal_dist"], "setor_ativ", "setores")
    return arrays.withColumn("setores", F.array_join("setores", ","))


@QUERIES.query("""SELECT emissor_da_ordem, min(data) AS data_min, max(data) AS data_max FROM fx_sales GROUP BY 1""")
def range_by(inputs: Inputs) -> DataFrame:
    return aggregate.range_by(inputs.view("fx_sales"), ["emissor_da_ordem"], "data")


@QUERIES.query("""SELECT material, count(*) AS linhas FROM fx_sales GROUP BY 1 HAVING count(*) > 35""")
def having_lines(inputs: Inputs) -> DataFrame:
    return aggregate.having(inputs.view("fx_sales"), ["material"], F.col("linhas") > 35,
                            linhas=F.count(F.lit(1)))


@QUERIES.query("""SELECT org_vendas, sum(n1) AS "01", sum(n2) AS "02" FROM (
    SELECT org_vendas, material, count(*) FILTER (WHERE canal_dist = '01') AS n1,
      count(*) FILTER (WHERE canal_dist = '02') AS n2 FROM fx_sales GROUP BY 1, 2) GROUP BY 1""")
def reaggregate(inputs: Inputs) -> DataFrame:
    ones = inputs.view("fx_sales").withColumn("n", F.lit(1).cast("bigint"))
    wide = aggregate.static_pivot(ones, ["org_vendas", "material"], "canal_dist", ["01", "02"], "n")
    return aggregate.reaggregate(wide, ["org_vendas"], ["01", "02"])


_COUNTED = ("numero_ov", "material", "emissor_da_ordem")


@QUERIES.query(f"""SELECT {", ".join(f"count(DISTINCT {c}) AS {c}, true AS {c}_no_limite" for c in _COUNTED)} FROM fx_sales""")
def distinct_over_loads(inputs: Inputs) -> DataFrame:
    """Exact distinct counts, and whether those of the sketches, stored per load and united, are within their bound."""
    sales = inputs.view("fx_sales").withColumn("carga", F.year("data"))
    path = scratch_path(inputs.spark, "sketches")
    aggregate.distinct_sketches(sales, ["carga"], _COUNTED).write.partitionBy("carga").parquet(path)
    united = aggregate.united_counts(inputs.spark.read.parquet(path), [], _COUNTED).first()
    exact = sales.agg(*[F.count_distinct(c).alias(c) for c in _COUNTED])
    return exact.select(*[c for name in _COUNTED for c in (
        F.col(name), (F.abs(F.col(name) - F.lit(united[name])) <= aggregate.SKETCH_BOUND * F.col(name)).alias(f"{name}_no_limite"))])

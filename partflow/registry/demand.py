"""Demand closing queries."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partflow.config import BOTH, CARS, DEMAND_VIEWS, MOTORCYCLES, SEGMENTS, DemandView
from partflow.functions.dates import label_of, last_months, shift_month
from partflow.operators.aggregate import max_of
from partflow.operators.project import latest_cycle
from partflow.plans import customers, demand, enrich, materials
from partflow.plans.monthly import MonthSums, month_parts
from partflow.registry.base import Family
from partflow.registry.fixtures import ANCHOR, Inputs
from partflow.session import scratch_path

QUERIES = Family()


class Closing:
    """Inputs of a closing, cleaned by the plans."""

    def __init__(self, inputs: Inputs):
        self.sales = inputs.view("fx_sales")
        self.chain = materials.material_chain(inputs.view("fx_master"))
        self.area = customers.customer_area(inputs.view("fx_area"))
        self.customer = customers.customer_master(inputs.view("fx_customer"))
        self.anchor = max_of(self.sales, "data").replace(day=1)

    def cube(self, months: int = 60) -> DataFrame:
        return enrich.demand_cube(self.sales, self.chain, self.area, self.anchor, months)

    def lean_base(self, months: int = 60) -> DataFrame:
        """The base without customers and areas."""
        return enrich.demand_base(self.sales, self.chain, None, None, months, self.anchor)

    def base(self, months: int = 60) -> DataFrame:
        return enrich.demand_base(self.sales, self.chain, self.area, self.customer, months, self.anchor)


def file_case(suffix: str, org: str = "org_vendas") -> str:
    cases = " ".join(f"WHEN '{s.org}' THEN '{s.tag} 2001 Ago {suffix}'" for s in SEGMENTS.values())
    return f"CASE {org} {cases} END"


def view_filter(view: DemandView) -> str:
    tests = ["1 = 1"]
    if view.channel:
        tests.append(f"canal_dist = '{view.channel}'")
    if view.only_type:
        tests.append(f"tipo_ov = '{view.only_type}'")
    if view.exclude_type:
        tests.append(f"tipo_ov <> '{view.exclude_type}'")
    return " AND ".join(tests)


def sheet_rows(view: DemandView, orgs: tuple[str, ...] = BOTH) -> str:
    """One SELECT per sheet, as a planner would run them one after the other."""
    keep = f"SELECT org_vendas, '{{sheet}}' AS sheet, {view.grain} AS item, emissor_da_ordem, mes, quantidade FROM ox_sales"
    parts = []
    for org in orgs:
        where = f" WHERE org_vendas = '{org}' AND {view_filter(view)}"
        parts.append(keep.format(sheet="TTL") + where)
        if org in view.center_orgs:
            parts += [keep.format(sheet=c) + where + f" AND centro_original = '{c}'"
                      for c in SEGMENTS[org].centers]
    return "\nUNION ALL ".join(parts)


def month_columns(view: DemandView) -> str:
    measure = "sum" if view.measure == "sum" else "count"
    return ", ".join(
        f"CAST(trunc(coalesce({measure}(quantidade) FILTER (WHERE mes = DATE '{m}'), 0)) AS INTEGER) AS \"{label_of(m)}\""
        for m in last_months(ANCHOR, view.months))


def view_sql(view: DemandView) -> str:
    by = ', emissor_da_ordem AS "Cliente"' if view.by_customer else ""
    extra = ", emissor_da_ordem" if view.by_customer else ""
    window = ("WHERE mes >= (SELECT m - INTERVAL 11 MONTH FROM ox_anchor)" if view.by_customer else "")
    return f"""SELECT {file_case(view.suffix)} AS file, sheet, item AS "{view.item_label}"{by}, {month_columns(view)}
        FROM ({sheet_rows(view)}) {window} GROUP BY org_vendas, sheet, item{extra}"""


def _register_view(name: str, view: DemandView) -> None:
    @QUERIES.query(view_sql(view), name)
    def build(inputs: Inputs) -> DataFrame:
        c = Closing(inputs)
        if view.by_customer:
            cube = enrich.customer_cube(c.sales, c.chain, c.anchor, view.months, view.only_type)
            return demand.urgent_by_customer(cube, c.anchor).drop("org_vendas")
        return demand.demand_view(c.cube(view.months), view.key, c.anchor).drop("org_vendas")


for _name, _key in {
    "demand_closed": "fechada", "demand_closed_no_zesp": "fechada_sem_zesp", "demand_open": "aberta",
    "demand_lines": "linha", "demand_domestic": "mi", "demand_export": "me",
    "demand_export_no_zesp": "me_sem_zesp", "demand_urgent": "zpug",
    "demand_urgent_customer": "zpug_cliente",
}.items():
    _register_view(_name, DEMAND_VIEWS[_key])


@QUERIES.query(view_sql(DEMAND_VIEWS["fechada"]).replace("ox_sales", "ox_sales_keyed"))
def demand_closed_late(inputs: Inputs) -> DataFrame:
    """The closed demand from stored monthly sums after a late batch, which corrects quantities and dates of two months."""
    spark, root, c = inputs.spark, scratch_path(inputs.spark, "closing"), Closing(inputs)
    sales = month_parts(spark, f"{root}/sales")
    sums = MonthSums(spark, f"{root}/sums", sales)
    late = (F.col("numero_ov") % 3 == 0) & F.col("data").between("2001-04-01", "2001-05-31")
    first = c.sales.withColumns({
        "quantidade": F.when(late, F.col("quantidade") * 2).otherwise(F.col("quantidade")),
        "data": F.when(late, F.date_add("data", 40)).otherwise(F.col("data"))})
    sales.refresh(first, 0)
    sums.update()
    sales.upsert(c.sales.where(late), 1)
    changed = sums.update()
    if not {date(2001, 4, 1)} <= {*changed} <= {date(2001, month, 1) for month in (4, 5, 6, 7)}:
        raise ValueError(f"other months than those of the batch were summed: {changed}")
    cube = enrich.cube_of_sums(sums.read(sums.anchor(), 60), c.chain, c.area)
    return demand.demand_view(cube, "fechada", sums.anchor()).drop("org_vendas")


@QUERIES.query("SELECT * FROM ox_base")
def demand_base(inputs: Inputs) -> DataFrame:
    return Closing(inputs).base()


_ITEM_VIEWS = [v for v in DEMAND_VIEWS.values() if not v.by_customer]


@QUERIES.query("\nUNION ALL ".join(
    f"""SELECT '{v.key}' AS visao, org_vendas, sheet, item, mes,
        CAST({'sum' if v.measure == 'sum' else 'count'}(quantidade) AS DECIMAL(38,3)) AS valor
        FROM ({sheet_rows(v)}) GROUP BY org_vendas, sheet, item, mes""" for v in _ITEM_VIEWS))
def demand_all_views(inputs: Inputs) -> DataFrame:
    """Every view of a closing in long form, from one aggregation."""
    c = Closing(inputs)
    measures = demand.demand_measures(c.cube(), _ITEM_VIEWS)
    picked = F.array(*[
        F.when(
            (F.col("grain") == v.grain) & (F.col(f"{v.key}__n") > 0)
            & ((F.col("sheet") == "TTL") | F.col("org_vendas").isin(*v.center_orgs)),
            F.struct(F.lit(v.key).alias("visao"), F.col(v.key).cast("decimal(38,3)").alias("valor")))
        for v in _ITEM_VIEWS])
    return measures.select(
        "org_vendas", "sheet", "item", "mes", F.explode(picked).alias("v"),
    ).where("v IS NOT NULL").select("v.visao", "org_vendas", "sheet", "item", "mes", "v.valor")


_ABC_MONTHS = [label_of(m) for m in last_months(ANCHOR, 6)]
_ABC_COLUMNS = ", ".join(
    f"CAST(count(quantidade) FILTER (WHERE mes = DATE '{m}') AS INTEGER) AS \"{label_of(m)}\""
    for m in last_months(ANCHOR, 6))
_ABC_SUM = " + ".join(f'"{m}"' for m in _ABC_MONTHS)


def abc_sql(orgs: tuple[str, ...]) -> str:
    return f"""
    SELECT file, sheet, item AS "Item Principal Cadeia", {", ".join(f'"{m}"' for m in _ABC_MONTHS)}, sum_6m,
      CASE WHEN total > 0 THEN sum_6m / total ELSE 0.0::DOUBLE END AS part_perc,
      CASE WHEN total > 0 THEN acc / total ELSE 0.0::DOUBLE END AS perc_acc, "rank",
      CASE WHEN sum_6m = 0 THEN 'E' WHEN total <= 0 OR acc / total <= 0.75::DOUBLE THEN 'A'
        WHEN acc / total <= 0.85::DOUBLE THEN 'B' WHEN acc / total <= 0.95::DOUBLE THEN 'C' ELSE 'D' END AS classe_linha
    FROM (SELECT *, CAST(sum(sum_6m) OVER (PARTITION BY file, sheet) AS BIGINT) AS total,
        CAST(sum(sum_6m) OVER (PARTITION BY file, sheet ORDER BY sum_6m DESC, item
          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS acc,
        CAST(row_number() OVER (PARTITION BY file, sheet ORDER BY sum_6m DESC, item) AS INTEGER) AS "rank"
      FROM (SELECT *, CAST({_ABC_SUM} AS INTEGER) AS sum_6m
        FROM (SELECT {file_case("Demanda Linha")} AS file, sheet, item, {_ABC_COLUMNS}
          FROM ({sheet_rows(DEMAND_VIEWS["linha"], orgs)}) GROUP BY org_vendas, sheet, item)))"""


@QUERIES.query(abc_sql((MOTORCYCLES,)))
def demand_abc(inputs: Inputs) -> DataFrame:
    c = Closing(inputs)
    return demand.demand_abc(c.cube(), c.anchor).drop("org_vendas")


def _half_up(value: str) -> str:
    """Rounds the decimal text of a double, as Spark does."""
    return f"CAST(round(CAST(CAST({value} AS VARCHAR) AS DECIMAL(38,18)), 2) AS DOUBLE)"


PAST = shift_month(ANCHOR, -6)


def _shares_sql(months: int, on: str, names: dict[str, str], anchor: date) -> str:
    columns = ", ".join(
        f"CAST(trunc(coalesce(sum(quantidade) FILTER (WHERE {on} = '{code}'), 0)) AS INTEGER) AS \"{name}\""
        for code, name in names.items())
    total = " + ".join(f'"{n}"' for n in names.values())
    percents = ", ".join(
        "CASE WHEN total > 0 THEN " + _half_up(f'CAST("{n}" AS DOUBLE) / total * 100')
        + f' ELSE 0.0 END AS "pct_{n}"' for n in names.values())
    return f"""SELECT *, {percents} FROM (SELECT *, CAST({total} AS BIGINT) AS total FROM (
        SELECT item_principal_cadeia AS item, {columns} FROM ox_sales
        WHERE org_vendas = '{{org}}' AND mes BETWEEN DATE '{shift_month(anchor, 1 - months)}' AND DATE '{anchor}'
        GROUP BY item_principal_cadeia))"""


def distribution_sql(org: str, anchor: date = ANCHOR, month: str = "Ago") -> str:
    segment = SEGMENTS[org]
    centers = {c: c for c in (*segment.centers, "null")}
    markets = {"02": "ME", "01": "MI"}
    a = _shares_sql(6, "coalesce(centro_original, 'null')", centers, anchor).format(org=org)
    b = _shares_sql(12, "canal_dist", markets, anchor).format(org=org)
    columns = []
    for side, names in (("a", centers.values()), ("b", markets.values())):
        columns += [f'coalesce({side}."{n}", 0) AS "DMD_{n}"' for n in names]
        columns += [f'coalesce({side}."pct_{n}", 0.0) AS "%_{n}"' for n in names]
    return f"""SELECT '{segment.tag} 2001 {month} Distribuição' AS file, 'TTL' AS sheet,
        coalesce(a.item, b.item) AS "Item Principal Cadeia", {", ".join(columns)}
        FROM ({a}) a FULL JOIN ({b}) b ON a.item = b.item"""


@QUERIES.query(distribution_sql(MOTORCYCLES))
def demand_distribution(inputs: Inputs) -> DataFrame:
    c = Closing(inputs)
    return demand.distribution(c.cube(12), MOTORCYCLES, c.anchor)


@QUERIES.query(distribution_sql(CARS))
def demand_distribution_cars(inputs: Inputs) -> DataFrame:
    c = Closing(inputs)
    return demand.distribution(c.cube(12), CARS, c.anchor)


@QUERIES.query(distribution_sql(MOTORCYCLES, PAST, "Fev"))
def demand_distribution_past(inputs: Inputs) -> DataFrame:
    """A month closed again later: sales after it are not part of it."""
    c = Closing(inputs)
    cube = enrich.demand_cube(c.sales, c.chain, c.area, PAST, 12)
    return demand.distribution(cube, MOTORCYCLES, PAST)


_PAST_ROWS = f"(SELECT * FROM ox_sales WHERE mes <= DATE '{PAST}')"


@QUERIES.query(f"""
    SELECT org_vendas, sheet, item, mes, CAST(sum(quantidade) AS DECIMAL(38,3)) AS valor
    FROM ({sheet_rows(DEMAND_VIEWS["fechada"]).replace("FROM ox_sales", f"FROM {_PAST_ROWS}")})
    WHERE mes > DATE '{shift_month(PAST, -24)}' GROUP BY 1, 2, 3, 4""")
def demand_closed_past(inputs: Inputs) -> DataFrame:
    c = Closing(inputs)
    view = DEMAND_VIEWS["fechada"]
    cube = enrich.demand_cube(c.sales, c.chain, c.area, PAST, 24)
    measures = demand.demand_measures(cube, [view])
    return measures.where((F.col("fechada__n") > 0) & ((F.col("sheet") == "TTL") | F.col("org_vendas").isin(*view.center_orgs))).select(
        "org_vendas", "sheet", "item", "mes", F.col("fechada").cast("decimal(38,3)").alias("valor"))


@QUERIES.query("SELECT m AS ciclo FROM ox_anchor")
def demand_latest_month(inputs: Inputs) -> DataFrame:
    return latest_cycle(inputs.view("fx_sales"), "data")

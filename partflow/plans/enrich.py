"""Sales rows with chain item, customer area and customer data."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partflow.functions.dates import month_start, shift_month
from partflow.functions.labels import CENTER_LABELS, MARKET_LABELS, SEGMENT_LABELS, label
from partflow.functions.numbers import trunc_int
from partflow.operators.joins import lookup_join, lookup_joins
from partflow.operators.project import apply_mapping, closed_month_window

# The keys of a customer's sales area.
AREA_KEYS = {"emissor_da_ordem": "cliente", "org_vendas": "orgv", "canal_dist": "cdst",
             "setor_ativ": "sa"}

# Names and types of the analytical base, in output order.
BASE_MAPPING = {
    "numero_ov": ("numero_ordem_venda", "string"),
    "item": ("item_ordem_venda", "string"),
    "data": ("data_ordem", "date"),
    "tipo_ov": ("tipo_ordem_venda", "string"),
    "org_vendas": ("organizacao_vendas", "string"),
    "canal_dist": ("canal_distribuicao", "string"),
    "emissor_da_ordem": ("codigo_cliente", "string"),
    "centro": ("centro_fornecedor", "string"),
    "material": ("codigo_material", "string"),
    "quantidade": ("quantidade", None),
    "item_principal_cadeia": ("item_principal_cadeia", "string"),
    "centro_original": ("centro_distribuicao_original", "string"),
    "razao_social": ("cliente", "string"),
    "estado": ("uf_cliente", "string"),
    "pais": ("pais_cliente", "string"),
    "segmento": ("segmento", "string"),
    "mercado": ("mercado", "string"),
    "centro_nome": ("centro_nome", "string"),
}


def enrich_chain(rows: DataFrame, chain: DataFrame, material: str = "material",
                 org: str = "org_vendas", name: str = "item_principal_cadeia") -> DataFrame:
    """Adds the main chain item; a material outside the chain table is its own item."""
    lookup = chain.select("empresa", "material", F.col("item_principal_cadeia").alias("_main"))
    joined = lookup_join(rows, lookup, {material: "material", org: "empresa"})
    return joined.withColumn(name, F.coalesce("_main", material)).drop("_main")


# What the base shows of a customer.
CUSTOMER_COLUMNS = ("razao_social", "estado", "pais")


def area_lookup(area: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    return area.select(*AREA_KEYS.values(), F.col("cen").alias("centro_original")), AREA_KEYS


def customer_lookup(customer: DataFrame, columns: Sequence[str] = CUSTOMER_COLUMNS
                    ) -> tuple[DataFrame, dict[str, str]]:
    return customer.select("cliente", *columns), {"emissor_da_ordem": "cliente"}


def enrich_area(rows: DataFrame, area: DataFrame) -> DataFrame:
    """Adds the centre that serves the customer."""
    return lookup_joins(rows, [area_lookup(area)])


def enrich_customer(rows: DataFrame, customer: DataFrame,
                    columns: Sequence[str] = CUSTOMER_COLUMNS) -> DataFrame:
    return lookup_joins(rows, [customer_lookup(customer, columns)])


def demand_base(sales: DataFrame, chain: DataFrame, area: DataFrame | None, customer: DataFrame | None,
                months: int = 60, anchor: date | None = None) -> DataFrame:
    """The analytical base: one typed, labelled row per order item of the window.

    Without the areas or the customers it lacks their columns, and their joins.
    """
    rows = closed_month_window(sales, "data", months, anchor, half_open=True)
    rows = enrich_chain(rows, chain)
    # The customer key is part of the area key, so both lookups share one shuffle of the rows.
    lookups = ([customer_lookup(customer)] if customer is not None else []) + ([area_lookup(area)] if area is not None else [])
    rows = lookup_joins(rows, lookups)
    rows = rows.withColumns({
        "quantidade": trunc_int(F.col("quantidade")),
        "segmento": label(F.col("org_vendas"), SEGMENT_LABELS),
        "mercado": label(F.col("canal_dist"), MARKET_LABELS),
        "centro_nome": label(F.col("centro"), CENTER_LABELS),
    })
    return apply_mapping(rows, {c: target for c, target in BASE_MAPPING.items() if c in rows.columns})


def up_to_month(sales: DataFrame, anchor: date, months: int) -> DataFrame:
    """The months that end with the anchor's."""
    day = F.col("data")
    return sales.where((day >= F.lit(shift_month(anchor, 1 - months))) & (day < F.lit(shift_month(anchor, 1))))


MEASURES = ("quantidade", "linhas", "registros")


def _monthly(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sums of sales rows: quantity, rows with a quantity, rows."""
    return rows.groupBy(*keys, month_start(F.col("data")).alias("mes")).agg(
        F.sum("quantidade").alias("quantidade"), F.count("quantidade").alias("linhas"),
        F.count(F.lit(1)).alias("registros"))


def _resummed(sums: DataFrame, keys: Sequence[str]) -> DataFrame:
    return sums.groupBy(*keys, "mes").agg(*[F.sum(m).alias(m) for m in MEASURES])


#: Keys of the partial sums: those of the area lookup and of the views.
SUM_KEYS = ("org_vendas", "canal_dist", "tipo_ov", "setor_ativ", "emissor_da_ordem", "material")
CUBE_KEYS = ("org_vendas", "canal_dist", "tipo_ov", "centro_original", "material")
CUSTOMER_KEYS = ("org_vendas", "canal_dist", "tipo_ov", "emissor_da_ordem", "material")


def partial_sums(sales: DataFrame) -> DataFrame:
    """Monthly sums of sales rows from which every view of a closing can be summed; sums of parts of the sales add up."""
    return _monthly(sales, SUM_KEYS)


def cube_of_sums(sums: DataFrame, chain: DataFrame, area: DataFrame) -> DataFrame:
    """The demand cube from partial sums."""
    return enrich_chain(_resummed(enrich_area(sums, area), CUBE_KEYS), chain)


def demand_cube(sales: DataFrame, chain: DataFrame, area: DataFrame, anchor: date,
                months: int = 60) -> DataFrame:
    """Monthly sums that every demand view is read from.

    The sales are summed to the keys of the lookup first: a lookup row multiplies a sum
    exactly as it would multiply its rows, and the join sees the sums only. Sales after
    the anchor's month are not part of a closing. Measures: ``quantidade``, ``linhas``
    (rows with a quantity), ``registros`` (rows).
    """
    return cube_of_sums(partial_sums(up_to_month(sales, anchor, months)), chain, area)


def customer_cube(sales: DataFrame, chain: DataFrame, anchor: date, months: int = 12,
                  only_type: str | None = None) -> DataFrame:
    """Monthly sums per customer and material, with the material's chain item."""
    window = up_to_month(sales, anchor, months)
    if only_type is not None:
        window = window.where(F.col("tipo_ov") == only_type)
    return enrich_chain(_monthly(window, CUSTOMER_KEYS), chain)


def customer_cube_of_sums(sums: DataFrame, chain: DataFrame, only_type: str | None = None) -> DataFrame:
    """The customer cube from partial sums."""
    if only_type is not None:
        sums = sums.where(F.col("tipo_ov") == only_type)
    return enrich_chain(_resummed(sums, CUSTOMER_KEYS), chain)

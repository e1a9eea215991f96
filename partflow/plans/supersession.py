"""Supersession map: from an original material to the finished item that replaces it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partflow.config import IN_HOUSE_BUYERS, MATERIAL_TYPES
from partflow.functions.codes import clean_variant, company_of, main_item
from partflow.operators.aggregate import keep_one_to_one
from partflow.operators.joins import lookup_join, null_safe, null_safe_side
from partflow.operators.project import in_domain

KEYS = ("empresa", "material")


def bom_rows(bom: DataFrame) -> DataFrame:
    """Bill of materials with the company; variants of finished items are left out."""
    rows = bom.withColumn("empresa", company_of(F.col("centro")))
    return rows.where(~F.col("material").rlike(r"\s+(C|G|NP)$"))


def bom_components(bom: DataFrame, master: DataFrame) -> DataFrame:
    """Bill rows whose component has an eligible type, with the component's chain field."""
    parts = in_domain(master, "tipo_de_material", MATERIAL_TYPES).select(
        "empresa", F.col("material").alias("_part"), "item_principal_cadeia")
    return lookup_join(bom, parts, {"empresa": "empresa", "componente": "_part"}, how="inner").select(
        "empresa", "material", "componente", "item_principal_cadeia")


def supersession_edges(bom: DataFrame, master: DataFrame) -> DataFrame:
    """Component item to produced item, for products made of exactly one component.

    Unpacked components (suffix ``N``) and products assembled in house give no edge, and
    neither does a product without a buyer.
    """
    single = keep_one_to_one(bom_components(bom_rows(bom), master), KEYS)
    component = main_item(F.col("item_principal_cadeia"), F.col("componente"))
    single = single.select(
        *KEYS, component.alias("item_principal_cadeia_componente"),
    ).where(~F.col("item_principal_cadeia_componente").rlike(r"\s+N$"))
    products = in_domain(master, "grupo_de_compradores", IN_HOUSE_BUYERS, negate=True).select(
        *KEYS, "item_principal_cadeia")
    produced = main_item(F.col("item_principal_cadeia"), F.col("material"))
    return lookup_join(single, products, {c: c for c in KEYS}, how="inner").select(
        "empresa", "item_principal_cadeia_componente",
        produced.alias("item_principal_cadeia_material_produzido"),
    ).distinct()


def _named_rows(master: DataFrame) -> DataFrame:
    """Eligible materials with their clean code and its item."""
    eligible = in_domain(master, "tipo_de_material", MATERIAL_TYPES).select(
        *KEYS, clean_variant(F.col("material"), F.col("empresa"), F.col("grupo_de_compradores"))
        .alias("material_sem_cgn"))
    items = master.select("empresa", F.col("material").alias("_code"),
                          F.col("item_principal_cadeia").alias("_item"))
    coded = lookup_join(eligible, items, {"empresa": "empresa", "material_sem_cgn": "_code"})
    return coded.select(
        *KEYS, "material_sem_cgn",
        main_item(F.col("_item"), F.col("material_sem_cgn"))
        .alias("item_principal_cadeia_material_sem_cgn"))


def _final_rows(named: DataFrame, edges: DataFrame, *shared: str) -> DataFrame:
    """The named rows with each item that replaces theirs."""
    final = lookup_join(
        named, edges, {"empresa": "empresa",
                       "item_principal_cadeia_material_sem_cgn": "item_principal_cadeia_componente",
                       **{c: c for c in shared}}, counted=False)
    return final.select(
        *KEYS, "material_sem_cgn", "item_principal_cadeia_material_sem_cgn",
        main_item(F.col("item_principal_cadeia_material_produzido"),
                  F.col("item_principal_cadeia_material_sem_cgn"))
        .alias("item_principal_cadeia_material_final"))


def supersession_rows(master: DataFrame, edges: DataFrame) -> DataFrame:
    """Every candidate: a material has as many rows as its item has produced items."""
    return _final_rows(_named_rows(master), edges)


def supersession_map(master: DataFrame, edges: DataFrame) -> DataFrame:
    """One row per material; of several finished items the smallest code counts.

    The smallest produced item per component is taken before the join, so the fan-out
    never happens.
    """
    smallest = edges.groupBy("empresa", "item_principal_cadeia_componente").agg(
        F.min(main_item(F.col("item_principal_cadeia_material_produzido"),
                        F.col("item_principal_cadeia_componente")))
        .alias("item_principal_cadeia_material_produzido"))
    rows = supersession_rows(master, smallest)
    rest = [c for c in rows.columns if c not in KEYS]
    best = F.min(F.struct("item_principal_cadeia_material_final", *rest[:2])).alias("_best")
    return rows.groupBy(*KEYS).agg(best).select(*KEYS, *[F.col(f"_best.{c}").alias(c) for c in rest])


#: An item of more produced items than this meets its materials in SHARES tasks.
HOT_ITEM, SHARES = 1000, 32


def supersession_fanout(master: DataFrame, edges: DataFrame) -> DataFrame:
    """The candidates of materials that have more than one.

    They are counted from the items' numbers of produced items, so only the result has a row per candidate.
    """
    item = {"empresa": "empresa", "item_principal_cadeia_material_sem_cgn": "item_principal_cadeia_componente"}
    named = _named_rows(master)
    sizes = edges.groupBy(*item.values()).agg(F.count(F.lit(1)).alias("_n"))
    shares = F.when(F.col("_n") > HOT_ITEM, SHARES).otherwise(1)
    counted = lookup_join(named, sizes, item, counted=False)
    several = counted.groupBy(*KEYS).agg(F.sum(F.coalesce("_n", F.lit(1))).alias("_rows")).where("_rows > 1")
    side = null_safe_side(several, KEYS)
    rows = counted.join(side, null_safe(counted, side, KEYS), "left_semi").withColumn(
        "_share", F.pmod(F.xxhash64(*KEYS, "material_sem_cgn"), shares))
    dealt = lookup_join(edges, sizes, {c: c for c in item.values()}, "inner", counted=False)
    return _final_rows(rows, _dealt(dealt, shares), "_share")


def _dealt(edges: DataFrame, shares: Column) -> DataFrame:
    return edges.withColumn("_share", F.explode(F.sequence(F.lit(0).cast("bigint"), shares.cast("bigint") - 1))).drop("_n")

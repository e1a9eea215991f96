"""Supersession queries."""

from __future__ import annotations

from pyspark.sql import DataFrame

from partflow.plans import supersession
from partflow.registry.base import Family
from partflow.registry.fixtures import Inputs

QUERIES = Family()


def edges_of(inputs: Inputs) -> tuple[DataFrame, DataFrame]:
    master = inputs.view("fx_master")
    return master, supersession.supersession_edges(inputs.view("fx_bom"), master)


@QUERIES.query("SELECT * FROM ox_edges")
def supersession_edges(inputs: Inputs) -> DataFrame:
    return edges_of(inputs)[1]


@QUERIES.query("""
    SELECT empresa, material, min(material_sem_cgn) AS material_sem_cgn,
      min(item_principal_cadeia_material_sem_cgn) AS item_principal_cadeia_material_sem_cgn,
      min(item_principal_cadeia_material_final) AS item_principal_cadeia_material_final
    FROM ox_depara GROUP BY 1, 2""")
def supersession_map(inputs: Inputs) -> DataFrame:
    return supersession.supersession_map(*edges_of(inputs))


@QUERIES.query("""
    SELECT * FROM ox_depara QUALIFY count(*) OVER (PARTITION BY empresa, material) > 1""")
def supersession_fanout(inputs: Inputs) -> DataFrame:
    return supersession.supersession_fanout(*edges_of(inputs))

"""Customer sales areas and customer master."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partflow.functions.codes import default_center, strip_zeros
from partflow.operators.project import normalize_columns

# ERP headings of the customer master and their names here.
MASTER_NAMES = {"ps": "pais", "local": "cidade", "rg": "estado", "nome_3": "razao_social"}


def customer_area(raw: DataFrame) -> DataFrame:
    """Sales area per customer, organisation, channel and sector; missing centres filled."""
    df = normalize_columns(raw)
    return df.withColumns({
        "cliente": strip_zeros(F.col("cliente")),
        "cen": default_center(F.col("orgv"), F.col("cen")),
    })


def customer_master(raw: DataFrame) -> DataFrame:
    df = normalize_columns(raw, MASTER_NAMES)
    return df.withColumn("cliente", strip_zeros(F.col("cliente")))

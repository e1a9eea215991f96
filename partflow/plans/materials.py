"""Material master: chain table, consumer view and export."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partflow.functions.codes import clean_chain, main_item, main_item_plain
from partflow.operators.project import consumer_view, normalize_columns, with_audit
from partflow.operators.state import drop_null_keys
from partflow.sources.readers import with_reference_date


def load_master(raw: DataFrame, load_id: str, now: Column, user: str,
                load_type: str = "full") -> DataFrame:
    """All-text master from tabular files, with the month of the file names."""
    df = drop_null_keys(normalize_names(raw), ["material"])
    return with_audit(with_reference_date(df), load_id, now, user, load_type)


def normalize_names(raw: DataFrame) -> DataFrame:
    lineage = [c for c in raw.columns if c.startswith("_source_")]
    business = raw.select(*[F.col(f"`{c}`") for c in raw.columns if c not in lineage])
    names = normalize_columns(business).columns
    return raw.select(
        *[F.col(f"`{c}`").alias(n) for c, n in zip(business.columns, names)], *lineage)


def material_chain(master: DataFrame) -> DataFrame:
    """Main chain item per company and material, without variant suffix."""
    item = main_item(F.col("item_principal_cadeia"), F.col("material"))
    return master.select(
        "empresa", "material",
        clean_chain(item, F.col("empresa"), F.col("grupo_de_compradores"))
        .alias("item_principal_cadeia"))


def material_view(master: DataFrame) -> DataFrame:
    """Master for consumers: no audit columns, every material has a main item."""
    return consumer_view(master, item_principal_cadeia=main_item_plain(
        F.col("item_principal_cadeia"), F.col("material")))


# Columns of the master export.
EXPORT_COLUMNS = (
    "material", "empresa", "descricao_curta_portugues", "descricao_curta_ingles",
    "item_principal_cadeia", "prazo_entrega_prevista_lead_time_firme",
)


def material_export(master: DataFrame, columns: Sequence[str] = EXPORT_COLUMNS) -> DataFrame:
    """Selected columns; zero texts also count as no main item."""
    item = main_item(F.col("item_principal_cadeia"), F.col("material"), zeros=True)
    return master.select(*[
        item.alias(c) if c == "item_principal_cadeia" else F.col(c) for c in columns])

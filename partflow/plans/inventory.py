"""Monthly inventory snapshot and stock by chain item."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partflow.config import (
    INVENTORY_KEYS, INVENTORY_QUANTITIES, MATERIAL_TYPES, STOCK_PARTS,
)
from partflow.functions.numbers import locale_decimal, round_half_up, total_of, unfit_number
from partflow.operators.project import consumer_view, in_domain
from partflow.operators.quality import (
    enforce, gate_cells, gate_columns, gate_conflict, gate_not_empty,
)
from partflow.operators.state import dedupe_latest
from partflow.session import settle


def inventory_source(master: DataFrame) -> DataFrame:
    return in_domain(master, "tipo_de_material", MATERIAL_TYPES).select(
        *INVENTORY_KEYS, *INVENTORY_QUANTITIES)


def inventory_cells(source: DataFrame) -> DataFrame:
    """Quantity texts as decimals, rounded half up, and in ``_bad`` those that are no number or do not fit.

    Each text is parsed once.
    """
    read = source.select("*", *[locale_decimal(F.col(c)).alias(f"_{c}") for c in INVENTORY_QUANTITIES])
    bad = [F.when(unfit_number(F.col(c), F.col(f"_{c}")), F.concat_ws(": ", F.lit(c), F.col(c)))
           for c in INVENTORY_QUANTITIES]
    return read.select(*INVENTORY_KEYS, *[round_half_up(F.col(f"_{c}")).alias(c) for c in INVENTORY_QUANTITIES],
                       F.array_compact(F.array(*bad)).alias("_bad"))


def inventory_numbers(source: DataFrame) -> DataFrame:
    return inventory_cells(source).drop("_bad")


def inventory_rows(master: DataFrame, reference: date) -> DataFrame:
    """One row per company, material and centre with the total stock."""
    return stock_rows(inventory_numbers(inventory_source(master)), reference)


def stock_rows(numbers: DataFrame, reference: date) -> DataFrame:
    rows = dedupe_latest(numbers, INVENTORY_KEYS)
    return rows.select(
        "centro", "material", "empresa", *INVENTORY_QUANTITIES,
        total_of(STOCK_PARTS).alias("estoque_total"), F.lit(reference).alias("reference_date"))


def inventory_snapshot(master: DataFrame, reference: date) -> DataFrame:
    """The snapshot after all its gates. Publish it by (month, company, centre)."""
    enforce(gate_columns(master, [*INVENTORY_KEYS, *INVENTORY_QUANTITIES, "tipo_de_material"]))
    # Settled: the gates and the rows read the parsed cells, and no text is parsed again.
    cells = settle(inventory_cells(inventory_source(master)))
    enforce(
        gate_not_empty(cells, "inventory"),
        gate_cells(cells, INVENTORY_KEYS, "_bad"),
        gate_conflict(cells, INVENTORY_KEYS, INVENTORY_QUANTITIES),
    )
    return stock_rows(cells.drop("_bad"), reference)


def inventory_view(snapshot: DataFrame) -> DataFrame:
    return consumer_view(snapshot, hidden=(
        "_ingested_at", "_ingested_by", "_load_id", "_source_file_path"))

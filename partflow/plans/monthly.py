"""Stored sales by month and their partial sums, which a closing is read from without going back to the sales."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partflow.config import SALES_KEYS
from partflow.functions.dates import month_start, shift_month
from partflow.plans.enrich import partial_sums
from partflow.sinks.parts import KeyedParts, PartFolder

#: Columns of the sales that a closing is summed from.
SALES_SCHEMA = (
    "numero_ov bigint, item bigint, data date, tipo_ov string, org_vendas string, canal_dist string, setor_ativ string, "
    "centro string, emissor_da_ordem bigint, material string, quantidade decimal(18,3), mes date"
)
SUMS_SCHEMA = (
    "org_vendas string, canal_dist string, tipo_ov string, setor_ativ string, emissor_da_ordem bigint, material string, "
    "quantidade decimal(28,3), linhas bigint, registros bigint, mes date"
)


def month_parts(spark: SparkSession, root: str, schema: str = SALES_SCHEMA) -> KeyedParts:
    """Keyed sales with a part per month. A row that changes its date moves, so a batch also touches months it has left."""
    return KeyedParts(spark, root, SALES_KEYS, "mes", month_start(F.col("data")), schema, by_key=False)


class MonthSums:
    """Partial sums of stored sales, a part per month, brought up to date by summing the changed months only."""

    def __init__(self, spark: SparkSession, root: str, sales: KeyedParts):
        self.sales, self.sums = sales, PartFolder(spark, root, "mes", SUMS_SCHEMA)

    def update(self) -> list[date]:
        """Sums what the sales' versions since the last update have changed; returns these months."""
        done = max(self.sums.versions(), default=-1)
        versions = self.sales.parts.versions()
        if not versions or versions[-1] == done:
            return []
        months = self.sales.parts.changed(done)
        self.sums.write(partial_sums(self.sales.read(months)), months, versions[-1])
        return months

    def read(self, anchor: date, months: int) -> DataFrame:
        """The sums of the months that end with the anchor's; other months' folders are not read."""
        low, high = shift_month(anchor, 1 - months), shift_month(anchor, 0)
        return self.sums.read([month for month in self.sums.newest() if month is not None and low <= month <= high])

    def anchor(self) -> date:
        """The latest month with sales."""
        return self.sums.read().agg(F.max("mes")).first()[0]

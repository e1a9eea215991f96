"""Sales orders: text extracts and the historical bootstrap."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partflow.config import AUDIT_COLUMNS, LINEAGE_COLUMNS, SALES_COLUMNS, SALES_LAYOUT
from partflow.functions.dates import erp_date
from partflow.functions.numbers import erp_number, try_cast
from partflow.operators.project import blanks_to_null, normalize_columns, parse_delimited, with_audit
from partflow.operators.quality import GateError, missing_columns


def parse_sales(lines: DataFrame) -> DataFrame:
    """Typed sales rows from delimited report lines; lineage columns are kept."""
    fields = blanks_to_null(parse_delimited(lines, SALES_LAYOUT))
    lineage = [c for c in LINEAGE_COLUMNS if c in lines.columns]

    def typed(name: str, type_name: str) -> Column:
        if name not in SALES_LAYOUT:
            return F.lit(None).cast(type_name)
        if type_name == "date":
            return erp_date(F.col(name))
        if type_name == "string":
            return F.col(name)
        if type_name.startswith("decimal"):
            return erp_number(F.col(name), type_name)
        return try_cast(F.col(name), type_name)

    return fields.select(*[typed(n, t).alias(n) for n, t in SALES_COLUMNS.items()], *lineage)


def standardize_sales(lines: DataFrame, load_id: str, now: Column, user: str,
                      load_type: str = "INCREMENTAL") -> DataFrame:
    return with_audit(parse_sales(lines), load_id, now, user, load_type)


def sales_history(raw: DataFrame, load_id: str, now: Column, user: str,
                  load_type: str = "INITIAL_LOAD") -> DataFrame:
    """Bootstrap from historical files: any spelling of the names, missing quantities are 0."""
    df = normalize_columns(raw)
    absent = missing_columns(df, list(SALES_COLUMNS))
    if absent:
        raise GateError([("columns", ", ".join(absent), "missing")])
    quantity = F.coalesce(F.col("quantidade").cast("decimal(18,3)"), F.lit(0).cast("decimal(18,3)"))
    df = with_audit(df.withColumn("quantidade", quantity), load_id, now, user, load_type)
    lineage = [c for c in LINEAGE_COLUMNS if c in df.columns]
    return df.select(*SALES_COLUMNS, *lineage, *AUDIT_COLUMNS)

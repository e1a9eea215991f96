"""File deliveries: CSV, Parquet and one folder per workbook with one part per sheet."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from partflow.config import (
    DEFAULT_SHEET, SHEET_MAX_CELLS, SHEET_MAX_ROWS, SHEET_NAME_LENGTH, TOTAL_SHEET,
)
from partflow.operators.aggregate import union_all
from partflow.operators.joins import null_safe, null_safe_side
from partflow.operators.quality import enforce, violation
from partflow.session import settle

# Characters a worksheet cell or name must not hold, and formula starters.
CONTROL_CHARACTERS = "[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f]"
FORMULA_START = "^[=+\\-@\\t\\r]"
SHEET_NAME_FORBIDDEN = "[\\[\\]:*?/\\\\]"
#: Letters of a name that a number of up to ten digits leaves as they are.
STEM_LENGTH = SHEET_NAME_LENGTH - 11


def export_csv(df: DataFrame, path: str, sep: str = ",", single_file: bool = False) -> None:
    """CSV with header. ``single_file`` sends everything through one task; for small results."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).option("sep", sep).option(
        "encoding", "UTF-8").csv(path)


def safe_cell(c: Column) -> Column:
    """Text without control characters, with an apostrophe before a formula starter."""
    clean = F.regexp_replace(c, CONTROL_CHARACTERS, "")
    return F.when(clean.rlike(FORMULA_START), F.concat(F.lit("'"), clean)).otherwise(clean)


def sanitize_cells(df: DataFrame) -> DataFrame:
    return df.select(*[
        safe_cell(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, StringType)
        else F.col(f"`{f.name}`") for f in df.schema.fields
    ])


def safe_sheet_name(c: Column) -> Column:
    bare = F.regexp_replace(F.coalesce(c, F.lit("None")), SHEET_NAME_FORBIDDEN, "-")
    name = F.substring(F.trim(bare, F.lit("'")), 1, SHEET_NAME_LENGTH)
    return F.when(name == "", F.lit(DEFAULT_SHEET)).otherwise(name)


def name_stem(name: Column) -> Column:
    """What a name shares with every name that is numbered from it: its first letters, without numbers at their end."""
    return F.regexp_replace(F.substring(name, 1, STEM_LENGTH), r"(_[0-9]*)+\z", "")


def safe_sheet_names(sheets: DataFrame) -> DataFrame:
    """A valid, unique name per (file, sheet), the total sheet first.

    Names are given in sheet order; one that is taken gets the first of ``_2``, ``_3`` … that is free.
    """
    pairs = sheets.select("file", "sheet").distinct().withColumn(
        "nome", safe_sheet_name(F.col("sheet")))
    rest = F.coalesce(F.upper("sheet") != TOTAL_SHEET, F.lit(True))
    # Only names of one stem can meet, so a group holds the sheets of a stem, not those of a workbook.
    stems = pairs.groupBy("file", name_stem(F.col("nome")).alias("stem")).agg(F.sort_array(F.collect_list(F.struct(
        rest.alias("rest"), "sheet", "nome"))).alias("sheets"))

    def free_name(taken: Column, name: Column) -> Column:
        numbered = F.transform(F.sequence(F.lit(2), F.size(taken) + 2), lambda n: F.concat(
            F.substr(name, F.lit(1), F.least(F.lit(SHEET_NAME_LENGTH - 3), F.lit(SHEET_NAME_LENGTH - 1) - F.length(n.cast("string")))), F.lit("_"), n.cast("string")))
        return F.when(~F.array_contains(taken, name), name).otherwise(F.get(F.array_except(numbered, taken), F.lit(0)))

    none = F.array().cast("array<string>")
    names = F.aggregate("sheets", none, lambda taken, row: F.concat(taken, F.array(free_name(taken, row["nome"]))))
    named = stems.select("file", F.explode(F.arrays_zip("sheets", names.alias("nomes"))).alias("row")).select(
        "file", "row.sheets.rest", "row.sheets.sheet", F.col("row.nomes").alias("nome"))
    # Places count over a workbook; its sheets are sorted, which spills if need be.
    place = F.row_number().over(Window.partitionBy("file").orderBy("rest", "sheet"))
    return named.select("file", "sheet", "nome", place.alias("posicao"))


def row_limit(columns: int) -> int:
    return min(SHEET_MAX_ROWS, max(1, SHEET_MAX_CELLS // max(1, columns)))


def sheet_size_report(df: DataFrame, control: tuple[str, ...] = ("file", "sheet")) -> DataFrame:
    """Rows per sheet against what a worksheet of that width can hold."""
    limit = row_limit(len(df.columns) - len(control))
    sizes = df.groupBy(*control).agg(F.count(F.lit(1)).alias("linhas"))
    return sizes.withColumns({
        "limite": F.lit(limit).cast("bigint"), "excede": F.col("linhas") > limit})


def gate_sheet_size(df: DataFrame) -> DataFrame:
    return sheet_size_report(df).where("excede").select(*violation(
        "sheet_size", F.concat_ws("/", "file", "sheet"), F.col("linhas")))


def gate_file_paths(df: DataFrame, column: str = "file") -> DataFrame:
    """File names that would leave the delivery folder."""
    name = F.col(column)
    unsafe = F.contains(name, F.lit("/")) | F.contains(name, F.lit(".."))
    return df.select(column).distinct().where(unsafe).select(
        *violation("file_path", name, "must not hold / or .."))


def export_plan(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Which table feeds which sheet of which file; tables without control columns stand alone."""
    parts = []
    for name, df in tables.items():
        lower = {c.lower() for c in df.columns}
        if {"file", "sheet"} <= lower:
            parts.append(df.select(F.lit(name).alias("tabela"), "file", "sheet").distinct())
        else:
            parts.append(df.sparkSession.createDataFrame(
                [(name, name, None)], "tabela string, file string, sheet string"))
    return union_all(parts)


def export_sheets(df: DataFrame, path: str, sep: str = ",", order: tuple[str, ...] = (),
                  fit_worksheet: bool = False) -> DataFrame:
    """Delivers rows with ``file`` and ``sheet`` columns as ``path/file=…/sheet=…`` CSV folders.

    Folders have the safe sheet names, cells are cleaned, and rows go by ``order`` within a sheet. A large sheet
    is split over tasks and files. ``fit_worksheet`` refuses sheets that a workbook could not hold.
    Returns the sheet names with their position in the workbook.
    """
    enforce(gate_file_paths(df), *([gate_sheet_size(df)] if fit_worksheet else []))
    names = settle(safe_sheet_names(df.select("file", "sheet").distinct()))
    keys = null_safe_side(names, ["file", "sheet"], "nome")
    columns = [c for c in df.columns if c not in ("file", "sheet")]
    body = df.join(keys, null_safe(df, keys, ["file", "sheet"])).select("file", F.col("nome").alias("sheet"), *[
        safe_cell(F.col(f"`{c}`")).alias(c) if isinstance(df.schema[c].dataType, StringType) else F.col(f"`{c}`")
        for c in columns])
    if order:
        # Ranges keep the order over the files of a sheet, too.
        body = body.repartitionByRange("file", "sheet", *order).sortWithinPartitions("file", "sheet", *order)
    else:
        body = body.hint("rebalance", F.col("file"), F.col("sheet"))
    body.write.mode("overwrite").option("header", True).option("sep", sep).partitionBy("file", "sheet").csv(path)
    return names

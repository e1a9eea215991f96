"""Scans: text files in batch and as a stream, Parquet history, all-text tables, generators."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

REFERENCE_MONTH = r"(\d{4})\.(\d{2})"


def with_file_lineage(df: DataFrame) -> DataFrame:
    """File name, path and modification time of every row. Apply right after the scan."""
    return df.select(
        "*",
        F.col("_metadata.file_name").alias("_source_file_name"),
        F.col("_metadata.file_path").alias("_source_file_path"),
        F.col("_metadata.file_modification_time").alias("_source_file_modification_time"),
    )


def read_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    return with_file_lineage(spark.read.text(paths))


def read_lines_stream(spark: SparkSession, path: str, glob: str = "*.txt",
                      files_per_batch: int | None = None) -> DataFrame:
    """Text files of a folder as a stream, those already there included.

    Without ``files_per_batch`` all pending files form one batch, which the rules over
    the set of files rely on.
    """
    reader = spark.readStream.format("text").option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return with_file_lineage(reader.load(path))


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """Parquet files of a folder and all its subfolders."""
    return spark.read.option("recursiveFileLookup", "true").parquet(path)


def read_tabular_strings(spark: SparkSession, paths: str | Sequence[str], header: bool = True,
                         sep: str = ",", encoding: str = "UTF-8") -> DataFrame:
    """Delimited tables with every column as text, so that codes keep their zeros."""
    return (
        spark.read.option("header", header).option("inferSchema", False)
        .option("sep", sep).option("encoding", encoding).csv(paths)
    )


def with_reference_date(df: DataFrame, file: str = "_source_file_name",
                        name: str = "reference_date") -> DataFrame:
    """First day of the month in the file name (``yyyy.MM``); NULL when it has none."""
    year = F.regexp_extract(file, REFERENCE_MONTH, 1)
    month = F.regexp_extract(file, REFERENCE_MONTH, 2)
    return df.withColumn(name, F.try_to_date(F.concat_ws("-", year, month, F.lit("01")), "yyyy-MM-dd"))


def inline_rows(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)


def date_spine(spark: SparkSession, start: date | str, end: date | str, name: str = "data") -> DataFrame:
    """One row per day, both ends included."""
    first, last = F.lit(str(start)).cast("date"), F.lit(str(end)).cast("date")
    return spark.range(1).select(
        F.explode(F.sequence(first, last, F.expr("interval 1 day"))).alias(name))


def list_tables(spark: SparkSession, prefix: str = "", database: str | None = None) -> list[str]:
    """Names of the catalog's tables and views that start with a prefix."""
    return sorted(t.name for t in spark.catalog.listTables(database) if t.name.startswith(prefix))

"""The training corpus: what is removed from ``documents``, and the mix of what stays.

Each stage is given all that the one before kept, written as Parquet and read again. All but the last
return the columns of ``documents``; the last returns the rows that the mix takes words of, with what it takes.
"""

from __future__ import annotations

from partflow.llm import decontamination, lines, mixing, simhash, toxicity
from partflow.llm.common import table
from partflow.session import scratch_path
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go."""
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that occur, equal or nearly equal, earlier in the corpus go; every document stays."""
    return lines.dedupe_lines(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return simhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents contaminated by benchmark items go."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes: source, sizes, target, word ranges and how often each is taken."""
    return mixing.plan_mix(docs).where(F.col("taken") > 0)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("simhash_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
]

#: A learned classifier and edit similarities are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table, each result written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"corpus-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

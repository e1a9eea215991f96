"""Shared pieces of the text operators: tables, word patterns, document identity."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from partflow.session import scratch_path
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: What stands between words: runs of ASCII white space.
BLANKS = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z; every other character stays as it is. NULL stays NULL."""
    return F.translate(text, UPPER, LOWER)


def split_words(text: Column, between: str = BLANKS) -> Column:
    """What stands between matches of ``between``; NULL has no words. Splitting costs a third of extracting."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), between), "")


def count_words(text: Column) -> Column:
    """Number of runs without ASCII white space; NULL has none."""
    return F.size(split_words(text)).cast("long")


def text_tag(text: Column) -> Column:
    """64 bits of the text. With doc_id it names a document: rows that repeat both are one document."""
    return F.xxhash64(text)


def same(left: DataFrame, right: DataFrame, *names: str) -> Column:
    """Null-safe equality on columns that both sides have."""
    condition = left[names[0]].eqNullSafe(right[names[0]])
    for name in names[1:]:
        condition = condition & left[name].eqNullSafe(right[name])
    return condition


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over a value that is worked out once, also where body uses it inside a lambda."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, with underscores before those that columns of ``df`` have."""
    taken, found = {column.lower() for column in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        found.append(name)
    return found


def hex_digest(text: Column) -> Column:
    return F.sha2(text, 256)


#: The folder of the innermost passing().
_FOLDER: ContextVar[str | None] = ContextVar("folder", default=None)


@contextmanager
def passing(spark: SparkSession, name: str) -> Iterator[None]:
    """What is stored() inside is deleted at the end, and shuffles that no plan holds any more are given up: disk holds what is
    still read, not all that was. Results that leave have to be settled inside."""
    folder = scratch_path(spark, name)
    token = _FOLDER.set(folder)
    try:
        yield
    finally:
        _FOLDER.reset(token)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        give_up(spark)


def give_up(spark: SparkSession) -> None:
    """Spark deletes the files of shuffles and checkpoints once the driver's memory is cleared of what refers to them. That
    takes seconds: for the end of a pass, not for every step."""
    gc.collect()
    spark._jvm.System.gc()


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: later plans know its size and lose no work with an executor."""
    folder = _FOLDER.get()
    path = f"{folder}/{name}-{uuid.uuid4().hex}" if folder else scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

"""Tables in parts: every write replaces whole parts, and readers see the newest of each.

A part is a partition folder, of a month or of a range or hash of keys. A write of more than PART_FOLDERS parts packs them: its
files hold many parts each, gathered and in order of the part, so that files grow in number with the rows and not with the parts.
A write goes to a version of its own, with the list
of the parts it replaces beside it; parts that are listed and have no rows are empty from then on. Nothing is moved or
overwritten, so a reader that has started goes on, a failed write is not seen (its version has no success mark), and a
repeated write of a version has no second effect. The lists hold one row per part and write; the driver holds
the newest version of each part, as it holds the partition folders of any table.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from partflow.operators.joins import null_safe, null_safe_side
from partflow.operators.state import dedupe_latest
from partflow.session import settle
from partflow.sinks.tables import drop_folder, mark_done, move_folder, numbered

#: Keys up to this number are sent to every executor (a key takes some 50 bytes); more are joined by a shuffle.
BROADCAST_KEYS = 200_000
#: A write of up to so many parts gives each a folder; a folder costs a file, its opening and its move whatever it holds.
PART_FOLDERS = 200
#: The folders' own column; no column of a table may have this name.
VERSION = "_version"


def among(column: str, values: Sequence) -> Column:
    """The column holds one of the values, of which one may be NULL."""
    found = F.col(column).isin([value for value in values if value is not None])
    return found | F.col(column).isNull() if None in values else found


def newest_of(lists: Sequence) -> dict:
    """The newest version of every part, from lists in order of the versions."""
    start = max((v for v, whole, *_ in lists if whole), default=-1)
    return {part: v for v, _, part, _ in lists if v >= start}


class PartFolder:
    """``root/rows/_version=<n>/<part>=<value>`` and ``root/parts/_version=<n>``. ``schema`` names all columns, the part too."""

    def __init__(self, spark: SparkSession, root: str, part: str, schema: str):
        self.spark, self.root, self.part, self.schema = spark, root.rstrip("/"), part, schema

    def versions(self) -> list[int]:
        return numbered(self.spark, f"{self.root}/rows", f"{VERSION}=")

    def write(self, df: DataFrame, parts: DataFrame | Sequence, version: int, whole: bool = False) -> None:
        """Replaces the listed parts, or with ``whole`` the table, by the rows of ``df``."""
        if isinstance(parts, DataFrame):
            parts = [row[0] for row in parts.select(self.part).distinct().collect()]
        packed = len({*parts}) > PART_FOLDERS
        self._list(parts, dict(df.dtypes)[self.part], version, whole, packed)
        writer = self._in_order(df).write if packed else df.write.partitionBy(self.part)
        writer.mode("overwrite").parquet(f"{self.root}/rows/{VERSION}={version}")

    def replace(self, df: DataFrame, version: int) -> None:
        """The table is the rows of ``df`` from now on. They are worked out once and kept aside until their parts are known."""
        aside, target = f"{self.root}/aside/{VERSION}={version}", f"{self.root}/rows/{VERSION}={version}"
        self._in_order(df).write.mode("overwrite").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(aside)
        rows = self.spark.read.schema(df.schema).parquet(aside)
        parts = [row[0] for row in rows.select(self.part).distinct().collect()]
        if len(parts) <= PART_FOLDERS:
            self.write(rows, parts, version, whole=True)
            drop_folder(self.spark, aside)
            return
        drop_folder(self.spark, target)
        self._list(parts, dict(df.dtypes)[self.part], version, True, True)
        move_folder(self.spark, aside, target)
        mark_done(self.spark, target)

    def _in_order(self, df: DataFrame) -> DataFrame:
        return df.sortWithinPartitions(self.part)

    def _list(self, parts: Sequence, kind: str, version: int, whole: bool, packed: bool) -> None:
        listed = self.spark.createDataFrame([(value,) for value in {*parts}], f"part {kind}")
        listed.withColumns({"whole": F.lit(whole), "packed": F.lit(packed)}).coalesce(1).write.mode("overwrite").parquet(
            f"{self.root}/parts/{VERSION}={version}")

    def _lists(self, before: int | None = None) -> list:
        """Version, whole, part and packed of every listed part, in order of the versions."""
        versions = [n for n in self.versions() if before is None or n < before]
        if not versions:
            return []
        kind = self.spark.createDataFrame([], self.schema).schema[self.part].dataType.simpleString()
        lists = self.spark.read.schema(f"part {kind}, whole boolean, packed boolean, {VERSION} long").option(
            "basePath", f"{self.root}/parts").parquet(*[f"{self.root}/parts/{VERSION}={n}" for n in versions])
        return sorted(lists.select(VERSION, "whole", "part", "packed").collect(), key=lambda row: row[0])

    def newest(self, before: int | None = None) -> dict:
        """The newest version of every part."""
        return newest_of(self._lists(before))

    def changed(self, since: int) -> list:
        """Parts that versions after ``since`` replaced, or dropped with the whole table."""
        before, now = self.newest(since + 1), self.newest()
        return [part for part in {**before, **now} if before.get(part) != now.get(part)]

    def read(self, parts: Sequence | None = None, before: int | None = None) -> DataFrame:
        """The rows of some parts or of all; only their folders are read, and of packed parts what the files' bounds let in."""
        lists, parts = self._lists(before), parts if parts is None else {*parts}
        newest = {part: v for part, v in newest_of(lists).items() if parts is None or part in parts}
        typed = self.spark.createDataFrame([], self.schema)
        if not newest:
            return typed
        values, sizes = {}, Counter(v for v, *_ in lists)
        for part, v in newest.items():
            values.setdefault(v, []).append(part)
        packed = {v for v, _, _, packed in lists if packed}
        found = [self._unpacked({n: values[n] for n in sorted({*values} - packed)})] if {*values} - packed else []
        found += [self._packed(n, values[n], sizes[n]) for n in sorted({*values} & packed)]
        return reduce(DataFrame.unionByName, [rows.select(*typed.columns) for rows in found])

    def _unpacked(self, values: dict) -> DataFrame:
        found = self.spark.read.schema(f"{self.schema}, {VERSION} long").option("basePath", f"{self.root}/rows").parquet(
            *[f"{self.root}/rows/{VERSION}={n}" for n in values])
        return found.where(reduce(Column.__or__, [among(self.part, parts) & (F.col(VERSION) == n) for n, parts in values.items()]))

    def _packed(self, version: int, parts: Sequence, size: int) -> DataFrame:
        found = self.spark.read.schema(self.schema).parquet(f"{self.root}/rows/{VERSION}={version}")
        if len(parts) == size:
            return found
        if len(parts) <= PART_FOLDERS:
            return found.where(among(self.part, parts))
        side = self.spark.createDataFrame([(value,) for value in parts], found.select(F.col(self.part).alias("_key0")).schema)
        return found.join(F.broadcast(side), null_safe(found, side, [self.part]), "left_semi")


class KeyedParts:
    """Keyed state in parts: a batch rewrites the parts it touches, and the other rows stay where they are.

    ``deal`` gives the part of a row. Where it follows from the keys (``by_key``), a batch touches the parts of its own
    rows; otherwise also those that hold an older row of its keys, which are looked up in the key columns alone, within the
    batch's range of the first key. The keys of a batch are broadcast, so the old rows are not shuffled. Of a batch that meets
    more than BROADCAST_KEYS, no key goes through the driver: the old rows of the parts that are rewritten move, to their keys
    and back to their parts.
    """

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], part: str, deal: Column, schema: str,
                 by_key: bool = True, order: Sequence[str] = ()):
        self.spark, self.keys, self.deal, self.by_key, self.order = spark, list(keys), deal, by_key, list(order)
        self.parts = PartFolder(spark, root, part, schema)

    def read(self, parts: Sequence | None = None) -> DataFrame:
        return self.parts.read(parts)

    def refresh(self, batch: DataFrame, version: int) -> None:
        """The batch is the state from now on."""
        self.parts.replace(self._gathered(self._placed(batch)), version)

    def upsert(self, batch: DataFrame, version: int) -> None:
        """Rows of the batch replace older rows of their keys."""
        placed = settle(self._placed(batch))
        own = self._own(placed)
        meet = self._meetings(placed, version, own)
        kept = self.kept(placed, meet, version, own)
        self.parts.write(kept.unionByName(self._gathered(placed)), [*(own | meet)], version)

    def _placed(self, batch: DataFrame) -> DataFrame:
        names = self.spark.createDataFrame([], self.parts.schema).schema
        rows = batch.withColumn(self.parts.part, self.deal)
        return dedupe_latest(rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in names]), self.keys, self.order)

    def _gathered(self, placed: DataFrame) -> DataFrame:
        """Few files per part; AQE splits a part that is too large for one task."""
        return placed.hint("rebalance", F.col(self.parts.part))

    def _own(self, placed: DataFrame) -> dict:
        """The parts of the batch's rows, with their number."""
        return {row[0]: row.n for row in placed.groupBy(self.parts.part).agg(F.count(F.lit(1)).alias("n")).collect()}

    def _meetings(self, placed: DataFrame, version: int, own: dict | None = None) -> dict:
        """Old parts that hold rows of the batch's keys, with the number of these keys at most."""
        if self.by_key:
            newest = self.parts.newest(version)
            return {value: n for value, n in (self._own(placed) if own is None else own).items() if value in newest}
        first, part = self.keys[0], self.parts.part
        low, high, rows, loose = placed.agg(
            F.min(first), F.max(first), F.count(F.lit(1)), F.count_if(F.col(first).isNull())).first()
        old = self.parts.read(before=version)
        if not loose:
            old = old.where(F.col(first).between(low, high))
        side = null_safe_side(placed, self.keys)
        side = F.broadcast(side) if rows <= BROADCAST_KEYS else side
        found = old.select(*self.keys, part).join(side, null_safe(old, side, self.keys), "left_semi")
        return {row[0]: min(row.n, rows) for row in found.groupBy(part).agg(F.count(F.lit(1)).alias("n")).collect()}

    def kept(self, placed: DataFrame, meet: dict, version: int, own: dict | None = None) -> DataFrame:
        """Old rows of the parts that are rewritten, without those of the batch's keys."""
        part, own = self.parts.part, self._own(placed) if own is None else own
        # Every part of the batch is rewritten as a whole, also where none of its keys are old.
        again = own | meet
        if not self.by_key:
            return self._without(list(again), placed, sum(own.values()), version)
        met = placed.where(among(part, list(meet))) if sum(meet.values()) <= BROADCAST_KEYS else placed
        return self._without(list(again), met, sum(meet.values()), version)

    def _without(self, values: Sequence, keys: DataFrame, count: int, version: int) -> DataFrame:
        old, side = self.parts.read(values, version), null_safe_side(keys, self.keys)
        few = count <= BROADCAST_KEYS
        side = F.broadcast(side) if few else side
        kept = old.join(side, null_safe(old, side, self.keys), "left_anti")
        # The shuffle deals the rows of every part to all tasks, each of which would write a file of it.
        return kept if few else self._gathered(kept)

"""Table folders on shared storage, written with Spark's own file writers.

A full replacement goes to a new version folder, an append to a folder of its own. Readers take the newest
version and its appends that carry the writer's success mark, so a failed or running write of these is never
seen. A scoped replacement overwrites partitions of the version in place: Spark moves them in when its job
commits, one after the other, and a reader at that moment can see some old and some new ones.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partflow.config import BOTH, SEGMENTS
from partflow.operators.aggregate import union_all
from partflow.operators.state import dedupe_latest, replace_scopes, upsert


# Fixed value: what Spark calls the partition of NULL.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def move_folder(spark: SparkSession, source: str, target: str) -> None:
    """Moves a folder to a place where nothing, or an older state of the same, may stand."""
    old, new = (spark._jvm.org.apache.hadoop.fs.Path(path) for path in (source, target))
    fs = new.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.delete(new, True)
    fs.mkdirs(new.getParent())
    if not fs.rename(old, new):
        raise OSError(f"{source} could not be moved to {target}")


def drop_folder(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def mark_done(spark: SparkSession, path: str) -> None:
    """Sets the writer's success mark, which makes the folder complete to readers."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")
    target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True).close()


def folder_names(spark: SparkSession, path: str) -> list[str]:
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in fs.listStatus(root) if s.isDirectory()]


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the complete folders below a path."""
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    done = "_SUCCESS"
    return [s.getPath().getName() for s in fs.listStatus(root)
            if s.isDirectory() and fs.exists(jvm.org.apache.hadoop.fs.Path(s.getPath(), done))]


def numbered(spark: SparkSession, path: str, prefix: str) -> list[int]:
    names = child_folders(spark, path)
    return sorted(int(n.removeprefix(prefix)) for n in names if n.startswith(prefix))


class TableFolder:
    """One table below ``root``: ``root/v=<n>``, its appends ``root/v<n>_add=<k>``.

    ``partition_by`` gives partition columns with their types; codes such as ``0200``
    would otherwise be read back as numbers. ``evolving`` tables are read with the union
    of all their files' columns, which costs a look at every file.
    """

    def __init__(self, spark: SparkSession, root: str,
                 partition_by: Mapping[str, str] | None = None, evolving: bool = False):
        self.spark, self.root, self.evolving = spark, root.rstrip("/"), evolving
        self.partition_by = dict(partition_by or {})

    def version(self) -> int | None:
        versions = numbered(self.spark, self.root, "v=")
        return versions[-1] if versions else None

    def path(self, version: int) -> str:
        return f"{self.root}/v={version}"

    def exists(self) -> bool:
        return self.version() is not None

    def read(self, version: int | None = None) -> DataFrame:
        version = self.version() if version is None else version
        if version is None:
            raise FileNotFoundError(f"no complete version below {self.root}")
        paths = [self.path(version), *(f"{self.root}/v{version}_add={n}" for n in self.appends(version))]
        return union_all([self._read(path) for path in paths])

    def appends(self, version: int) -> list[int]:
        return numbered(self.spark, self.root, f"v{version}_add=")

    def _read(self, path: str) -> DataFrame:
        found = self.spark.read.option("mergeSchema", self.evolving).parquet(path)
        if not self.partition_by:
            return found
        typed = ", ".join(f"`{n}` {self.partition_by.get(n, t)}" for n, t in found.dtypes)
        return self.spark.read.schema(typed).parquet(path)

    def partitions(self, column: str) -> set[str]:
        """Values of the first partition column, from the names of the folders; no data is read."""
        version = self.version()
        if version is None:
            return set()
        if next(iter(self.partition_by), None) != column:
            raise ValueError(f"{column} is not the first partition column")
        names = [name for folder in (self.path(version), *(f"{self.root}/v{version}_add={n}" for n in self.appends(version)))
                 for name in folder_names(self.spark, folder)]
        unescape = self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
        return {unescape(name.removeprefix(f"{column}=")) for name in names if name.startswith(f"{column}=")}

    def replace(self, df: DataFrame, gathered: bool = False) -> None:
        """Whole table, any schema. The former version stays readable for running queries."""
        latest = self.version()
        self._write(df, self.path(0 if latest is None else latest + 1), "overwrite", gathered)

    def append(self, df: DataFrame, gathered: bool = False) -> None:
        """Adds rows; in an evolving table new columns are NULL in the older rows.

        ``gathered`` tells that the rows of a partition lie in few tasks already, and need not be moved.
        """
        version = self.version()
        if version is None:
            self.replace(df, gathered)
        else:
            added = self.appends(version)
            self._write(df, f"{self.root}/v{version}_add={added[-1] + 1 if added else 0}", "overwrite", gathered)

    def replace_scopes(self, df: DataFrame) -> None:
        """Replaces only the partitions that occur in ``df``; the others are not read at all.

        A version with appends is written anew, since an append may hold rows of any partition.
        """
        if not self.partition_by:
            raise ValueError("a scoped replacement needs partition columns")
        version = self.version()
        if version is not None and self.appends(version):
            self.replace(replace_scopes(self.read(), df, list(self.partition_by)))
        else:
            self._write(df, self.path(version or 0), "overwrite", partitionOverwriteMode="dynamic")

    def _write(self, df: DataFrame, path: str, mode: str, gathered: bool = False, **options: str) -> None:
        if self.partition_by and not gathered:
            # Few files per partition; AQE splits a partition that is too large for one task.
            df = df.hint("rebalance", *[F.col(c) for c in self.partition_by])
        df.write.mode(mode).options(**options).partitionBy(*self.partition_by).parquet(path)


class BatchFolder:
    """Keyed state fed by numbered batches: ``root/batch=<n>``, whole ones ``root/refresh=<n>``, compacted ``root/upto=<n>``.

    A batch is written to its own folder, so a replayed batch overwrites itself and has
    no second effect. The cost of a batch does not depend on the size of the state. Of a key's rows the one of the
    latest batch counts, within a batch the greatest by ``order``, then by content.

    A refresh opens a generation: readers see its rows and those of later batches, and nothing from before. Older
    batches that are replayed after it change nothing, and a refresh that has not ended is not seen.

    Rows that have to be checked as they are stored are written aside (``stage``), read back by the checks
    (``staged``) and moved into place (``publish``): the input is read once, and a failed check leaves nothing.
    """

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], order: Sequence[str] = ()):
        self.spark, self.root, self.keys, self.order = spark, root.rstrip("/"), list(keys), list(order)

    def batches(self) -> list[int]:
        return sorted({*numbered(self.spark, self.root, "batch="), *self.refreshes()})

    def refreshes(self) -> list[int]:
        return numbered(self.spark, self.root, "refresh=")

    def compacted(self) -> int | None:
        done = numbered(self.spark, self.root, "upto=")
        return done[-1] if done else None

    def _place(self, batch_id: int, refresh: bool) -> str:
        """Where a batch goes. A batch keeps the mode it was completed in, and one that is compacted stays so."""
        compacted = self.compacted()
        if compacted is not None and batch_id <= compacted:
            raise ValueError(f"batch {batch_id} is compacted")
        mode, other = ("refresh", "batch") if refresh else ("batch", "refresh")
        if batch_id in numbered(self.spark, self.root, f"{other}="):
            raise ValueError(f"batch {batch_id} is stored as {other}")
        return f"{self.root}/{mode}={batch_id}"

    def write_batch(self, df: DataFrame, batch_id: int, refresh: bool = False) -> None:
        df.write.mode("overwrite").parquet(self._place(batch_id, refresh))

    def stage(self, df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{self.root}/_staged/{batch_id}")

    def staged(self, batch_id: int) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/_staged/{batch_id}")

    def publish(self, batch_id: int, refresh: bool = False) -> None:
        move_folder(self.spark, f"{self.root}/_staged/{batch_id}", self._place(batch_id, refresh))

    def read(self, before: int | None = None) -> DataFrame | None:
        """Latest row per key; None before the first batch. ``before`` leaves out that batch and later ones."""
        compacted, parts = self._parts(before)
        recent = dedupe_latest(union_all(parts), self.keys, ["batch", *self.order]).drop("batch") if parts else None
        if compacted is None:
            return recent
        return compacted if recent is None else upsert(compacted, recent, self.keys)

    def rows(self) -> DataFrame | None:
        """All stored rows of the generation, older ones of a key included: enough to tell what has arrived, without a shuffle."""
        compacted, parts = self._parts(None)
        found = ([compacted] if compacted is not None else []) + [part.drop("batch") for part in parts]
        return union_all(found) if found else None

    def pending(self) -> int:
        """Batches that a read has to resolve."""
        base = self.compacted()
        return sum(base is None or b > base for b in self.batches())

    def _parts(self, before: int | None) -> tuple[DataFrame | None, list[DataFrame]]:
        """The compacted rows a read starts from, if any, and the rows of every later batch with its number."""
        known = {mode: [n for n in numbered(self.spark, self.root, f"{mode}=") if before is None or n < before]
                 for mode in ("batch", "refresh", "upto")}
        upto, refresh = max(known["upto"], default=-1), max(known["refresh"], default=-1)
        start = max(upto, refresh)
        folders = [(n, f"{self.root}/batch={n}") for n in known["batch"] if n > start]
        if refresh > upto:
            folders.insert(0, (refresh, f"{self.root}/refresh={refresh}"))
        compacted = self.spark.read.parquet(f"{self.root}/upto={upto}") if upto >= max(refresh, 0) else None
        return compacted, [self.spark.read.parquet(path).withColumn("batch", F.lit(n)) for n, path in folders]

    def compact(self) -> None:
        """Settles all batches so far into one folder that later reads start from."""
        batches = self.batches()
        state = self.read()
        if state is not None and batches and batches[-1] != self.compacted():
            state.write.mode("overwrite").parquet(f"{self.root}/upto={batches[-1]}")


class HistoryFolder:
    """A type-2 history: current versions in ``root/current``, ended ones in ``root/closed``.

    A snapshot rewrites the current versions only and adds those it has ended under its
    month. Ended versions count once the current versions of their month are complete,
    so a load that breaks off in between has no effect and can be run again.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def months(self) -> list[int]:
        return numbered(self.spark, f"{self.root}/current", "month=")

    def current(self) -> DataFrame | None:
        months = self.months()
        return self.spark.read.parquet(f"{self.root}/current/month={months[-1]}") if months else None

    def read(self) -> DataFrame | None:
        """All versions; None before the first load."""
        current = self.current()
        if current is None:
            return None
        loaded = set(self.months())
        closed = [f"{self.root}/closed/month={m}"
                  for m in numbered(self.spark, f"{self.root}/closed", "month=") if m in loaded]
        return current.unionByName(self.spark.read.parquet(*closed)) if closed else current

    def write(self, touched: DataFrame, reference: date) -> tuple[int, int]:
        """Stores what a snapshot has kept, opened and ended; returns how many are current and how many have ended."""
        month = f"month={reference:%Y%m}"
        rows = touched.persist()
        try:
            rows.where("NOT is_current").write.mode("overwrite").parquet(f"{self.root}/closed/{month}")
            rows.where("is_current").write.mode("overwrite").parquet(f"{self.root}/current/{month}")
        finally:
            rows.unpersist()
        # Counts of whole Parquet files come from their footers.
        return tuple(self.spark.read.parquet(f"{self.root}/{kind}/{month}").count() for kind in ("current", "closed"))


def publish_segments(
    spark: SparkSession,
    root: str,
    name: str,
    df: DataFrame,
    mode: str = "multi_tabela",
    orgs: Sequence[str] = BOTH,
) -> list[str]:
    """Writes a view with an ``org_vendas`` column per segment or as one table.

    ``multi_tabela`` gives one table per segment (``<name>_HDA``, ``<name>_HAB``),
    ``tabela_unica`` one table partitioned by ``segmento``.
    """
    if mode == "tabela_unica":
        tag = F.lit(None).cast("string")
        for segment in SEGMENTS.values():
            tag = F.when(F.col("org_vendas") == segment.org, segment.tag).otherwise(tag)
        TableFolder(spark, f"{root}/{name}", {"segmento": "string"}).replace(
            df.withColumn("segmento", tag).drop("org_vendas"))
        return [name]
    names = []
    for segment in (SEGMENTS[org] for org in orgs):
        part = df.where(F.col("org_vendas") == segment.org).drop("org_vendas")
        names.append(f"{name}_{segment.tag}")
        TableFolder(spark, f"{root}/{names[-1]}").replace(part)
    return names


def annotate(spark: SparkSession, table: str, comment: str | None = None,
             columns: Mapping[str, str] | None = None,
             properties: Mapping[str, str] | None = None, version: str | None = None) -> bool:
    """Comments and properties of a catalog table; skipped when its version is already set."""
    marker = "metadata_version"
    if version is not None:
        stored = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
        if stored.get(marker) == version:
            return False

    def quoted(text: str) -> str:
        return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"

    if comment is not None:
        spark.sql(f"COMMENT ON TABLE {table} IS {quoted(comment)}")
    for column, text in (columns or {}).items():
        spark.sql(f"ALTER TABLE {table} ALTER COLUMN `{column}` COMMENT {quoted(text)}")
    values = {**(properties or {}), **({marker: version} if version is not None else {})}
    if values:
        pairs = ", ".join(f"{quoted(k)} = {quoted(v)}" for k, v in values.items())
        spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({pairs})")
    return True

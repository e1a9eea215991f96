"""Streaming ingestion: file stream, gates and keyed state, run to completion."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from partflow.config import SALES_KEYS
from partflow.functions.dates import local_timestamp
from partflow.operators.quality import GateError, enforce, file_stats, sales_file_gates
from partflow.operators.state import dedupe_latest
from partflow.plans.sales import parse_sales, standardize_sales
from partflow.session import settle
from partflow.sinks.tables import BatchFolder, path_exists
from partflow.sources.readers import read_lines

BatchFunction = Callable[[DataFrame, int], None]

#: A run that leaves so many batches behind settles them.
COMPACT_AFTER = 16
# A re-sent file is newer, so its rows win; the file name and the content settle ties.
NEWEST = ("_source_file_modification_time", "_source_file_name")


def run_available(stream: DataFrame, function: BatchFunction, checkpoint: str) -> None:
    """Processes everything that is there and stops. A failing batch stays unprocessed."""
    query = (
        stream.writeStream.foreachBatch(function).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()


def upsert_batches(state: BatchFolder, order: Sequence[Column | str] = (), refresh: Sequence[int] = ()) -> BatchFunction:
    """Keeps the latest row per key; the batches named in ``refresh`` replace the state. A replayed batch overwrites itself."""
    def write(batch: DataFrame, batch_id: int) -> None:
        state.write_batch(dedupe_latest(batch, state.keys, order), batch_id, batch_id in refresh)

    return write


def check_sales_files(rows: DataFrame, files: DataFrame, loaded: DataFrame | None = None) -> None:
    """Raises when any file of the set breaks a rule. ``rows`` are the parsed rows, ``files`` names all files.

    The rows in place are read only when an organisation has not arrived.
    """
    stats = file_stats(rows)
    try:
        enforce(sales_file_gates(stats, files))
    except GateError as error:
        if loaded is None or any(rule != "file_missing" for rule, _, _ in error.violations):
            raise
        enforce(sales_file_gates(stats, files, loaded))


# --- file versions -----------------------------------------------------------------

VERSION = "path string, file string, modified timestamp"


def pending_files(spark: SparkSession, folder: str, manifest: DataFrame | None,
                  glob: str = "*.txt") -> DataFrame:
    """Files that are new or were sent again, by name and modification time.

    ``manifest`` lists what was processed: ``file``, ``modified``.
    """
    listed = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder).select(
        "path", F.element_at(F.split("path", "/"), -1).alias("file"),
        F.col("modificationTime").alias("modified"))
    if manifest is None:
        return listed
    done = manifest.groupBy("file").agg(F.max("modified").alias("_done"))
    return listed.join(done, "file", "left").where(
        F.col("_done").isNull() | (F.col("modified") > F.col("_done"))).select("path", "file", "modified")


def announce(spark: SparkSession, folder: str, log: str, glob: str = "*.txt") -> bool:
    """Adds the file versions of a folder that the log does not hold yet; tells whether there were any."""
    known = spark.read.schema(VERSION).parquet(log) if path_exists(spark, log) else None
    new = pending_files(spark, folder, known, glob)
    if new.isEmpty():
        return False
    new.coalesce(1).write.mode("append").parquet(log)
    return True


def manifest_folder(spark: SparkSession, root: str) -> BatchFolder:
    """Processed files with their modification times, stored batch by batch like the rows."""
    return BatchFolder(spark, f"{root}/processed_files", ["file"])


def stream_versions(spark: SparkSession, folder: str, root: str, manifest: BatchFolder,
                    function: Callable[[DataFrame, int], None], glob: str = "*.txt") -> None:
    """Runs ``function`` on the pending file versions of a folder, as a stream run to completion.

    Spark's file stream takes a path once for good. Here the stream reads a log of file versions (path, time), to
    which every run adds what is new or was sent again; a batch gets all versions that the batches before it have
    not processed, and reads the files itself. So a file that is sent again under its name is taken again, a batch that
    failed is run again on what lies in the folder by then, and a replayed batch gets at least what it had before.
    """
    log = f"{root}/_arrivals"
    if not announce(spark, folder, log, glob) and not path_exists(spark, log):
        return

    def process(batch: DataFrame, batch_id: int) -> None:
        # Listed once: a file that changes from here on is newer than what is noted, and is taken again.
        versions = settle(pending_files(spark, folder, manifest.read(before=batch_id), glob))
        if versions.isEmpty():
            return
        function(versions, batch_id)
        manifest.write_batch(versions.select("file", "modified"), batch_id)

    run_available(spark.readStream.schema(VERSION).parquet(log), process, f"{root}/_checkpoint/arrivals")


def paths_of(versions: DataFrame) -> list[str]:
    """The paths of pending files, as a scan has to name them."""
    return [row.path for row in versions.select("path").collect()]


# --- sales -------------------------------------------------------------------------

LOAD_MODES = ("INCREMENTAL", "PERIOD_REFRESH")


def sales_state(spark: SparkSession, root: str) -> BatchFolder:
    return BatchFolder(spark, f"{root}/raw_sales_order", SALES_KEYS, NEWEST)


def is_refresh(mode: str) -> bool:
    if mode not in LOAD_MODES:
        raise ValueError(f"mode is one of {', '.join(LOAD_MODES)}")
    return mode == "PERIOD_REFRESH"


def load_sales(state: BatchFolder, versions: DataFrame, batch_id: int, load_id: str, user: str,
               now: Column | None = None, mode: str = "INCREMENTAL") -> None:
    """Parses, stores aside, checks and publishes one batch of files, or nothing of it.

    ``INCREMENTAL`` merges by key; ``PERIOD_REFRESH`` replaces the whole state, so rows in place do not stand in
    for an organisation that has not arrived.
    """
    refresh = is_refresh(mode)
    lines = read_lines(state.spark, paths_of(versions))
    moment = local_timestamp() if now is None else now
    state.stage(standardize_sales(lines, load_id, moment, user, mode), batch_id)
    check_sales_files(state.staged(batch_id), versions.select("file"), None if refresh else state.rows())
    state.publish(batch_id, refresh)


def settle_batches(*kept: BatchFolder) -> None:
    """Compacts what has gathered COMPACT_AFTER batches."""
    for state in kept:
        if state.pending() >= COMPACT_AFTER:
            state.compact()


def ingest_sales(spark: SparkSession, folder: str, root: str, load_id: str, user: str,
                 now: Column | None = None, mode: str = "INCREMENTAL", check_first: bool = False) -> BatchFolder:
    """Streams the pending sales files of a folder into the keyed state below ``root``.

    A batch that breaks a rule stores nothing, and the next run takes its files again as they are then. With
    ``check_first`` the files are also checked before the stream starts, which reads them once more.
    """
    is_refresh(mode)
    state, manifest = sales_state(spark, root), manifest_folder(spark, root)
    if check_first:
        preflight(spark, folder, manifest.read(), state.rows())

    def load(versions: DataFrame, batch_id: int) -> None:
        load_sales(state, versions, batch_id, load_id, user, now, mode)

    stream_versions(spark, folder, root, manifest, load)
    settle_batches(state, manifest)
    return state


def preflight(spark: SparkSession, folder: str, manifest: DataFrame | None,
              loaded: DataFrame | None = None) -> list[str]:
    """Checks the pending files before a load starts; returns their paths."""
    versions = settle(pending_files(spark, folder, manifest))
    paths = paths_of(versions)
    if paths:
        check_sales_files(parse_sales(read_lines(spark, paths)), versions.select("file"), loaded)
    return paths


def ingest_new_files(spark: SparkSession, folder: str, root: str, load_id: str, user: str,
                     now: Column | None = None, mode: str = "INCREMENTAL") -> list[str]:
    """Batch twin of the stream. A root is fed either by the stream or by this function, since both number batches."""
    if path_exists(spark, f"{root}/_checkpoint/arrivals"):
        raise ValueError(f"{root} is fed by a stream")
    state, manifest = sales_state(spark, root), manifest_folder(spark, root)
    versions = settle(pending_files(spark, folder, manifest.read()))
    found = sorted(row.file for row in versions.select("file").collect())
    if found:
        batch_id = max(state.batches(), default=-1) + 1
        load_sales(state, versions, batch_id, load_id, user, now, mode)
        manifest.write_batch(versions.select("file", "modified"), batch_id)
        settle_batches(state, manifest)
    return found

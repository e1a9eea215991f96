"""Material specification history (type 2)."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from partflow.config import (
    HISTORY_DATES, HISTORY_KEYS, HISTORY_TRACKED, LEAD_TIME_SOURCE, MATERIAL_TYPES,
)
from partflow.functions.dates import repair_date
from partflow.functions.hashing import row_hash
from partflow.operators.project import consumer_view, in_domain
from partflow.operators.quality import (
    GateError, enforce, gate_chronology, gate_columns, gate_divergence, gate_keys, gate_loaded,
)
from partflow.operators.state import open_versions, scd2_apply, scd2_changes, scd2_counts, scd2_start
from partflow.sinks.tables import HistoryFolder


def history_rows(master: DataFrame) -> DataFrame:
    """Trimmed, date-repaired rows per centre with their hash."""
    rows = in_domain(master, "tipo_de_material", MATERIAL_TYPES)
    source = {c: LEAD_TIME_SOURCE if c == "lead_time" else c for c in HISTORY_TRACKED}

    def cleaned(name: str) -> Column:
        text = F.trim(F.col(source.get(name, name)).cast("string"))
        return (repair_date(text) if name in HISTORY_DATES else text).alias(name)

    cleaned_rows = rows.select(*[cleaned(c) for c in (*HISTORY_KEYS, "centro", *HISTORY_TRACKED)])
    return cleaned_rows.withColumn("row_hash", row_hash(HISTORY_TRACKED))


def history_stage(rows: DataFrame) -> DataFrame:
    """One row per material; the divergence gate has shown that centres agree."""
    return rows.groupBy(*HISTORY_KEYS, "row_hash").agg(
        *[F.min(c).alias(c) for c in HISTORY_TRACKED],
    ).select(*HISTORY_KEYS, *HISTORY_TRACKED, "row_hash")


def checked_stage(current: DataFrame | None, master: DataFrame, reference: date,
                  audit: Mapping[str, Column] | None = None) -> DataFrame:
    """The snapshot as new versions, after all gates."""
    enforce(gate_columns(master, [*HISTORY_KEYS, "centro", "tipo_de_material", LEAD_TIME_SOURCE]))
    rows = history_rows(master)
    gates = [gate_keys(rows, HISTORY_KEYS), gate_divergence(rows, HISTORY_KEYS)]
    if current is not None:
        gates += [gate_chronology(current, reference), gate_loaded(current, reference)]
    enforce(*gates)
    stage = open_versions(history_stage(rows), scd2_start(current, reference))
    return stage.withColumns(dict(audit or {}))


def ended_audit(audit: Mapping[str, Column] | None) -> dict[str, Column]:
    """Audit values an ended version takes; it keeps the time of its own ingestion."""
    return {c: v for c, v in (audit or {}).items() if c != "_ingested_at"}


def load_history(history: DataFrame | None, master: DataFrame, reference: date,
                 audit: Mapping[str, Column] | None = None) -> DataFrame:
    """Checks one snapshot and applies it; the result is the whole new state."""
    stage = checked_stage(history, master, reference, audit)
    if history is None:
        return stage
    return scd2_apply(history, stage, HISTORY_KEYS, reference, closed_audit=ended_audit(audit))


def load_history_folder(folder: HistoryFolder, master: DataFrame, reference: date,
                        audit: Mapping[str, Column] | None = None) -> dict[str, int]:
    """Loads one snapshot into stored history; ended versions of earlier months are not read.

    Returns how many versions are unchanged, changed, missing and added, counted while the snapshot is written. Where an
    executor was lost on the way they may count rows twice; then, as the stored rows tell, they are counted again.

    The month of a load is its place in the folder, so a month that has only ended
    versions cannot be loaded twice either.
    """
    done = folder.months()
    if done and done[-1] >= int(f"{reference:%Y%m}"):
        raise GateError([("chronology", f"{reference:%Y-%m}", f"{done[-1]} is loaded")])
    current = folder.current()
    stage = checked_stage(current, master, reference, audit)
    if current is None:
        return {"unchanged": 0, "changed": 0, "missing": 0, "added": folder.write(stage, reference)[0]}
    counted = Observation("versions")
    touched = scd2_changes(current, stage, HISTORY_KEYS, reference, closed_audit=ended_audit(audit), counted=counted)[1]
    kept, ended = folder.write(touched, reference)
    counts = counted.get
    if (counts["unchanged"] + counts["changed"] + counts["added"], counts["changed"] + counts["missing"]) != (kept, ended):
        counts = scd2_counts(current, stage, HISTORY_KEYS).first().asDict()
    return counts


def history_view(history: DataFrame) -> DataFrame:
    return consumer_view(history, hidden=(
        "_ingested_at", "_last_updated_at", "_ingested_by", "_load_type", "_load_id",
        "_source_file_path"))

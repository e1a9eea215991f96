"""Quality gates.

A gate returns the violations as rows ``(rule, subject, detail)``; ``enforce`` raises when
there are any. All of them are stored; only counts and the first ones reach the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from partflow.config import SALES_FILE_PATTERN, SEGMENTS
from partflow.functions.codes import is_blank
from partflow.functions.hashing import payload_hash
from partflow.functions.labels import label
from partflow.functions.numbers import invalid_number
from partflow.operators.aggregate import union_all
from partflow.operators.joins import null_safe, null_safe_side, scope_rows
from partflow.operators.project import invalid_keys
from partflow.operators.state import decimal_migration_checks, scd2_state
from partflow.session import scratch_path

FILE_ORGS = {s.org: s.wheels for s in SEGMENTS.values()}
VIOLATION = "rule string, subject string, detail string"


class GateError(ValueError):
    """Raised when a gate finds violations; nothing may be written after it.

    ``violations`` are the first ones in order, ``counts`` how many each rule has, and ``path`` the folder
    (Parquet) that holds all of them.
    """

    def __init__(self, violations: Sequence[tuple[str, str, str]], counts: Mapping[str, int] | None = None,
                 path: str | None = None):
        self.violations, self.counts, self.path = list(violations), dict(counts or {}), path
        listed = "; ".join(f"{r}: {s} ({d})" for r, s, d in self.violations)
        more = sum(self.counts.values()) - len(self.violations)
        super().__init__(listed + (f"; {more} more in {path}" if more > 0 else ""))


def violation(rule: str, subject: Column | str, detail: Column | str = "") -> list[Column]:
    def text(c: Column | str) -> Column:
        return F.lit(c) if isinstance(c, str) else c.cast("string")

    return [F.lit(rule).alias("rule"), text(subject).alias("subject"), text(detail).alias("detail")]


def joined_keys(keys: Sequence[str]) -> Column:
    return F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("NULL")) for k in keys])


def enforce(*gates: DataFrame, sample: int = 100) -> None:
    """Raises when a gate has violations: all are stored, counted by rule, and the first ones listed."""
    found = union_all(gates)
    if found.isEmpty():
        return
    path = scratch_path(found.sparkSession, "violations")
    found.write.parquet(path)
    stored = found.sparkSession.read.parquet(path)
    counts = {row["rule"]: row["count"] for row in stored.groupBy("rule").count().collect()}
    first = stored.orderBy("rule", "subject", "detail").limit(sample).collect()
    raise GateError([tuple(row) for row in first], counts, path)


def one_row(spark: SparkSession, rule: str, subject: str, detail: str, failed: bool) -> DataFrame:
    """A violation that is known from the schema alone."""
    rows = [(rule, subject, detail)] if failed else []
    return spark.createDataFrame(rows, VIOLATION)


# --- sales files -------------------------------------------------------------------


def file_stats(rows: DataFrame, file: str = "_source_file_name", day: str = "data",
               org: str = "org_vendas") -> DataFrame:
    """Per file: rows, rows without a date, first and last month, organisations.

    The rows are counted per file and organisation first, with measures that a hash
    aggregation can hold; the organisations are compared on those few rows.
    """
    parts = rows.groupBy(F.col(file).alias("file"), F.col(org).alias("org")).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col(day).isNull()).alias("null_dates"),
        F.min(day).alias("lo"), F.max(day).alias("hi"))
    return parts.groupBy("file").agg(
        F.sum("rows").alias("rows"),
        F.sum("null_dates").alias("null_dates"),
        F.date_format(F.min("lo"), "yyyy-MM").alias("min_period"),
        F.date_format(F.max("hi"), "yyyy-MM").alias("max_period"),
        F.min("org").alias("min_org"),
        F.max("org").alias("max_org"),
    )


def named_files(files: DataFrame, pattern: str = SALES_FILE_PATTERN) -> DataFrame:
    """Splits file names into period, organisation and segment; NULL where they do not fit."""
    def part(i: int, name: str) -> Column:
        return F.when(F.col("file").rlike(pattern),
                      F.regexp_extract("file", pattern, i)).alias(name)

    return files.select("*", part(1, "period"), part(2, "org"), part(3, "seg"))


Rule = tuple[Column, str, Column]


def rule_file_name() -> Rule:
    return F.col("period").isNull(), "file_name", F.lit("name does not match the pattern")


def rule_org(orgs: Mapping[str, str]) -> Rule:
    """Organisation known, and its segment as expected."""
    expected = label(F.col("org"), orgs)
    failed = F.col("period").isNotNull() & ~expected.eqNullSafe(F.col("seg"))
    detail = F.when(expected.isNull(), F.lit("unknown organisation")).otherwise(
        F.concat(F.lit("segment should be "), expected))
    return failed, "file_org", detail


def rules_content(orgs: Mapping[str, str]) -> list[Rule]:
    """Rules over the rows of files with a known organisation.

    At least one row; no row without a date; all dates in the month of the name; the
    organisation of the name and no other (rows without one do not count).
    """
    known = F.col("org").isin(*orgs)
    filled = known & (F.col("rows") > 0)
    period = (F.col("min_period").eqNullSafe(F.col("period"))
              & F.col("max_period").eqNullSafe(F.col("period")))
    org = F.col("min_org").eqNullSafe(F.col("org")) & F.col("max_org").eqNullSafe(F.col("org"))
    return [
        (known & (F.coalesce("rows", F.lit(0)) == 0), "file_empty", F.lit("no valid row after parsing")),
        (filled & (F.col("null_dates") > 0), "file_null_dates", F.col("null_dates").cast("string")),
        (filled & ~period, "file_period", F.concat_ws(" to ", "min_period", "max_period")),
        (filled & ~org, "file_content_org", F.concat_ws(" to ", "min_org", "max_org")),
    ]


def apply_rules(rows: DataFrame, rules: Sequence[Rule], subject: Column) -> DataFrame:
    """All violations of row rules in one pass over the rows."""
    found = F.array_compact(F.array(*[
        F.when(failed, F.struct(F.lit(name).alias("rule"), subject.cast("string").alias("subject"),
                                detail.alias("detail")))
        for failed, name, detail in rules]))
    return rows.select(F.explode(found).alias("v")).select("v.*")


def gate_file_content(named: DataFrame, orgs: Mapping[str, str] = FILE_ORGS) -> DataFrame:
    """The rules of each single file, over named files with their statistics."""
    return apply_rules(named, [rule_file_name(), rule_org(orgs), *rules_content(orgs)], F.col("file"))


def arrivals(named: DataFrame, orgs: Mapping[str, str] = FILE_ORGS) -> DataFrame:
    """Files per period and expected organisation; 0 where an organisation is missing."""
    return (
        named.where(F.col("org").isin(*orgs)).groupBy("period")
        .agg(*[F.count_if(F.col("org") == o).alias(o) for o in orgs])
        .select("period", F.explode(F.array(*[
            F.struct(F.lit(o).alias("org"), F.col(f"`{o}`").alias("n")) for o in orgs])).alias("a"))
        .select("period", "a.org", "a.n")
    )


def gate_file_set(named: DataFrame, loaded: DataFrame | None = None,
                  orgs: Mapping[str, str] = FILE_ORGS) -> DataFrame:
    """One file per period and organisation, and every organisation of a period present.

    An organisation that is loaded already for the period does not count as missing.
    ``loaded`` holds the sales rows in place; only their months and organisations count.
    """
    counts = arrivals(named, orgs)
    missing = F.col("n") == 0
    if loaded is not None:
        months = loaded.select(
            F.trunc("data", "month").alias("_month"), F.col("org_vendas").alias("org"),
        ).distinct().select(
            F.date_format("_month", "yyyy-MM").alias("period"), "org", F.lit(True).alias("_loaded"))
        counts = counts.join(months, ["period", "org"], "left")
        missing = missing & F.col("_loaded").isNull()
    return apply_rules(counts, [
        (F.col("n") > 1, "file_repeated", F.col("n").cast("string")),
        (missing, "file_missing", F.lit("organisation did not arrive")),
    ], F.concat_ws(" ", "period", "org"))


def gate_missing_org(named: DataFrame, loaded: DataFrame | None = None,
                     orgs: Mapping[str, str] = FILE_ORGS) -> DataFrame:
    return gate_file_set(named, loaded, orgs).where("rule = 'file_missing'")


def sales_file_gates(stats: DataFrame, files: DataFrame | None = None,
                     loaded: DataFrame | None = None,
                     orgs: Mapping[str, str] = FILE_ORGS) -> DataFrame:
    """All file rules. ``files`` lists the arriving files when some may have no rows."""
    if files is None:
        with_stats = names = named_files(stats)
    else:
        names = named_files(files.select("file"))
        with_stats = names.join(stats, "file", "left")
    return union_all([gate_file_content(with_stats, orgs), gate_file_set(names, loaded, orgs)])


# --- tables ------------------------------------------------------------------------


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    return [c for c in required if c not in df.columns]


def gate_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    missing = missing_columns(df, required)
    return one_row(df.sparkSession, "columns", ", ".join(missing), "missing", bool(missing))


def gate_type(df: DataFrame, column: str, type_name: str) -> DataFrame:
    actual = dict(df.dtypes).get(column, "missing")
    return one_row(df.sparkSession, "type", column, f"{actual} is not {type_name}",
                   actual != type_name)


def gate_not_empty(df: DataFrame, subject: str = "snapshot") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n")).where("n = 0").select(
        *violation("empty", subject, "no rows"))


def gate_reference_date(df: DataFrame, column: str = "reference_date") -> DataFrame:
    """Exactly one reference date on all rows. An empty input has no violation."""
    stats = df.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col(column).isNull()).alias("nulls"),
        F.min(column).alias("lo"), F.max(column).alias("hi"))
    return stats.where((F.col("n") > 0) & ((F.col("nulls") > 0) | (F.col("lo") != F.col("hi")))).select(
        *violation("reference_date", column,
                   F.concat_ws(", ", F.col("lo").cast("string"), F.col("hi").cast("string"),
                               F.concat(F.col("nulls").cast("string"), F.lit(" empty")))))


def gate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return invalid_keys(df, keys).select(*violation("key", joined_keys(keys), "empty key part"))


def gate_numeric(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Texts that are no number or do not fit; one row per value."""
    return apply_rules(df, [rule_number(c) for c in columns], joined_keys(keys))


def rule_number(column: str) -> Rule:
    text = F.col(column).cast("string")
    return invalid_number(text), "number", F.concat_ws(": ", F.lit(column), text)


def gate_cells(df: DataFrame, keys: Sequence[str], bad: str) -> DataFrame:
    """Key parts that are empty, and the cells that the parser has put into the list ``bad``."""
    empty = F.lit(False)
    for key in keys:
        empty = empty | is_blank(F.col(key).cast("string"))
    keyed = df.where(empty).select(*violation("key", joined_keys(keys), "empty key part"))
    cells = df.where(F.size(bad) > 0).select(joined_keys(keys).alias("_keys"), F.explode(bad).alias("_cell"))
    return keyed.unionByName(cells.select(*violation("number", F.col("_keys"), F.col("_cell"))))


def gate_conflict(df: DataFrame, keys: Sequence[str], payload: Sequence[str]) -> DataFrame:
    """Keys that come with different values; identical repetitions are allowed."""
    hashed = df.select(*keys, payload_hash(payload).alias("_h"))
    return hashed.groupBy(*keys).agg(F.count_distinct("_h").alias("n")).where("n > 1").select(
        *violation("conflict", joined_keys(keys), F.col("n")))


def gate_divergence(df: DataFrame, keys: Sequence[str], hash_column: str = "row_hash",
                    place: str = "centro") -> DataFrame:
    """Keys whose tracked values differ between places."""
    return df.groupBy(*keys).agg(
        F.count_distinct(hash_column).alias("n"), F.count_distinct(place).alias("p"),
    ).where("n > 1").select(*violation(
        "divergence", joined_keys(keys),
        F.concat(F.col("n").cast("string"), F.lit(" versions in "), F.col("p").cast("string"),
                 F.lit(" places"))))


def gate_duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(
        *violation("duplicate", joined_keys(keys), F.col("n")))


def gate_chronology(history: DataFrame, reference: date) -> DataFrame:
    """Snapshots come in ascending order of their month."""
    moment = F.lit(datetime(reference.year, reference.month, 1)).cast("timestamp")
    latest = history.where("is_current").agg(F.max("start_date").alias("m"))
    return latest.where(moment <= F.col("m")).select(
        *violation("chronology", moment.cast("date"), F.col("m").cast("date")))


def gate_loaded(history: DataFrame, reference: date) -> DataFrame:
    """The month has not been loaded yet."""
    moment = F.lit(datetime(reference.year, reference.month, 1)).cast("timestamp")
    same = history.where(F.col("is_current") & (F.col("start_date") == moment))
    return same.agg(F.count(F.lit(1)).alias("n")).where("n > 0").select(
        *violation("loaded", moment.cast("date"), F.col("n")))


def gate_scd2_state(history: DataFrame, keys: Sequence[str]) -> DataFrame:
    """No key has more than one current version."""
    return scd2_state(history, keys).where("current_versions > 1").select(
        *violation("current_versions", joined_keys(keys), F.col("current_versions")))


def gate_lossless(df: DataFrame, column: str, precision: int = 18, scale: int = 2) -> DataFrame:
    checks = decimal_migration_checks(df, column, precision, scale)
    return checks.where("invalid_casts > 0 OR extra_decimals > 0").select(*violation(
        "lossless", column,
        F.concat_ws(" / ", F.col("invalid_casts").cast("string"),
                    F.col("extra_decimals").cast("string"))))


def gate_freshness(audit: DataFrame, upstream: str, downstream: Sequence[str],
                   operations: Sequence[str] = ("write", "replace", "append", "upsert")) -> DataFrame:
    """Every downstream table was written after the last load of its source.

    ``audit`` has one row per load: table, op, ts.
    """
    last = audit.where(F.col("op").isin(*operations)).groupBy("table").agg(F.max("ts").alias("ts"))
    source = last.where(F.col("table") == upstream).select(F.max("ts")).scalar()
    wanted = audit.sparkSession.createDataFrame([(t,) for t in downstream], "table string")
    states = wanted.join(last, "table", "left")
    stale = source.isNotNull() & ~F.coalesce(F.col("ts") >= source, F.lit(False))
    return states.where(stale).select(*violation(
        "freshness", F.col("table"), F.coalesce(F.col("ts").cast("string"), F.lit("never"))))


# --- reports -----------------------------------------------------------------------


def reconcile(source: DataFrame, kept: DataFrame, removed: DataFrame, key: str, qty: str,
              digits: int = 3) -> DataFrame:
    """Per key: rows and quantity of the source, of what was kept and of what was removed."""
    def totals(df: DataFrame, tag: str) -> DataFrame:
        return df.groupBy(key).agg(
            F.count(F.lit(1)).alias(f"rows_{tag}"), F.sum(qty).alias(f"qty_{tag}"))

    merged = totals(source, "source").join(totals(kept, "kept"), key, "full").join(
        totals(removed, "removed"), key, "left").fillna(0, ["rows_removed", "qty_removed"])
    diff = F.round(F.col("qty_source") - F.col("qty_kept") - F.col("qty_removed"), digits)
    return merged.withColumn("diff_qty", diff)


def residual(df: DataFrame, condition: Column, name: str = "residual") -> DataFrame:
    """How many rows still meet a rule that the output should have resolved."""
    return df.agg(F.count(F.lit(1)).alias("rows"), F.count_if(condition).alias(name))


def load_audit(df: DataFrame, order_key: str = "numero_ov", day: str = "data",
               groups: Sequence[str] = ("_load_id", "_ingested_by", "_source_file_name")) -> DataFrame:
    return df.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct(order_key).alias("orders"),
        F.min(day).alias("data_min"),
        F.max(day).alias("data_max"),
    )


def output_inventory(tables: Mapping[str, DataFrame], segment: str = "file") -> DataFrame:
    """Rows per output table and segment."""
    return union_all([
        df.groupBy(F.substring(segment, 1, 3).alias("segmento")).agg(F.count(F.lit(1)).alias("linhas"))
        .select(F.lit(name).alias("tabela"), "segmento", "linhas")
        for name, df in tables.items()
    ])


def lag_profile(df: DataFrame) -> DataFrame:
    return df.groupBy("lag").agg(
        F.count(F.lit(1)).alias("qtd_linhas"), F.sum("forecast_qty").alias("total_qty"))


def scope_count(df: DataFrame, batch: DataFrame, scopes: Sequence[str]) -> DataFrame:
    """Rows per scope, for the scopes of a batch."""
    found = scope_rows(null_safe_side(batch, scopes))
    inside = df.join(found, null_safe(df, found, scopes), "left_semi")
    return inside.groupBy(*scopes).agg(F.count(F.lit(1)).alias("rows"))

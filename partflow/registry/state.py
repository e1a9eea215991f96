"""Table change queries."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partflow.config import HISTORY_KEYS, HISTORY_TRACKED
from partflow.functions.hashing import row_hash
from partflow.operators import state
from partflow.plans import history
from partflow.registry.base import Family
from partflow.registry.fixtures import Inputs
from partflow.registry.scalars import _REPAIRED
from partflow.session import scratch_path, settle
from partflow.sinks.parts import KeyedParts
from partflow.sinks.tables import HistoryFolder

QUERIES = Family()

_LATEST = """
    SELECT user_id, event_id, ts, event_type, value FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"""


@QUERIES.query(_LATEST)
def dedupe_latest(inputs: Inputs) -> DataFrame:
    rows = inputs.table("events").select("user_id", "event_id", "ts", "event_type", "value")
    return state.dedupe_latest(rows, ["user_id"], ["ts", "event_id"])


_SALES_KEYED = """
    SELECT numero_ov, item, max(data) AS data, max(material) AS material, max(quantidade) AS quantidade
    FROM fx_sales {where} GROUP BY numero_ov, item"""


def sales_keyed(inputs: Inputs, where: str = "") -> DataFrame:
    return inputs.sql(_SALES_KEYED.format(where=where))


_UPSERTED = """
    SELECT b.numero_ov, b.item, b.data, b.material, b.quantidade * 2 AS quantidade
    FROM (SELECT numero_ov, item, max(data) AS data, max(material) AS material, max(quantidade) AS quantidade
      FROM fx_sales WHERE data >= DATE '2001-01-01' GROUP BY numero_ov, item) b
    UNION ALL
    SELECT o.numero_ov, o.item, o.data, o.material, o.quantidade
    FROM (SELECT numero_ov, item, max(data) AS data, max(material) AS material, max(quantidade) AS quantidade
      FROM fx_sales WHERE data < DATE '2001-04-01' GROUP BY numero_ov, item) o
    WHERE NOT EXISTS (SELECT 1 FROM fx_sales b WHERE b.data >= DATE '2001-01-01' AND b.numero_ov = o.numero_ov
      AND b.item = o.item)"""


@QUERIES.query(_UPSERTED)
def upsert(inputs: Inputs) -> DataFrame:
    old = sales_keyed(inputs, "WHERE data < DATE '2001-04-01'")
    batch = sales_keyed(inputs, "WHERE data >= DATE '2001-01-01'")
    batch = batch.withColumn("quantidade", (F.col("quantidade") * 2).cast("decimal(18,3)"))
    return state.upsert(old, batch, ["numero_ov", "item"])


@QUERIES.query(_UPSERTED)
def upsert_parts(inputs: Inputs) -> DataFrame:
    """The same batch on state stored by ranges of order numbers, where only the ranges it touches are written; it is replayed."""
    old = sales_keyed(inputs, "WHERE data < DATE '2001-04-01'")
    batch = sales_keyed(inputs, "WHERE data >= DATE '2001-01-01'")
    # The batch is replayed as it stands, not worked out anew.
    batch = settle(batch.withColumn("quantidade", (F.col("quantidade") * 2).cast("decimal(18,3)")))
    schema = "numero_ov bigint, item bigint, data date, material string, quantidade decimal(18,3), faixa bigint"
    stored = KeyedParts(inputs.spark, scratch_path(inputs.spark, "upsert_parts"), ["numero_ov", "item"], "faixa",
                        F.expr("numero_ov div 500"), schema)
    stored.refresh(old, 0)
    for _ in range(2):
        stored.upsert(batch, 1)
    return stored.read().drop("faixa")


@QUERIES.query("""
    SELECT mes, org_vendas, numero_ov, item, quantidade FROM (SELECT CAST(date_trunc('month', data) AS DATE) AS mes,
      org_vendas, numero_ov, item, quantidade FROM fx_sales) o
    WHERE NOT (org_vendas = '0200' AND mes >= DATE '2001-05-01')
    UNION ALL
    SELECT CAST(date_trunc('month', data) AS DATE), org_vendas, numero_ov, item, 0 FROM fx_sales
    WHERE org_vendas = '0200' AND data >= DATE '2001-05-01' AND quantidade > 10""")
def replace_scopes(inputs: Inputs) -> DataFrame:
    old = inputs.view("fx_sales").select(
        F.trunc("data", "month").alias("mes"), "org_vendas", "numero_ov", "item", "quantidade")
    batch = old.where("org_vendas = '0200' AND mes >= DATE '2001-05-01' AND quantidade > 10")
    batch = batch.withColumn("quantidade", F.lit(0).cast("decimal(18,3)"))
    return state.replace_scopes(old, batch, ["mes", "org_vendas"])


@QUERIES.query("""
    SELECT tipo_ov, org_vendas, numero_ov, item, quantidade FROM fx_sales
    WHERE NOT (org_vendas = '0200' AND (tipo_ov IS NULL OR tipo_ov = 'ZPUG'))
    UNION ALL SELECT tipo_ov, org_vendas, numero_ov, item, CAST(0 AS DECIMAL(18,3)) FROM fx_sales
    WHERE org_vendas = '0200' AND (tipo_ov IS NULL OR tipo_ov = 'ZPUG') AND quantidade > 10""")
def replace_scopes_null(inputs: Inputs) -> DataFrame:
    """A scope with a NULL part is replaced like any other."""
    old = inputs.view("fx_sales").select("tipo_ov", "org_vendas", "numero_ov", "item", "quantidade")
    batch = old.where("org_vendas = '0200' AND (tipo_ov IS NULL OR tipo_ov = 'ZPUG') AND quantidade > 10")
    batch = batch.withColumn("quantidade", F.lit(0).cast("decimal(18,3)"))
    return state.replace_scopes(old, batch, ["tipo_ov", "org_vendas"])


@QUERIES.query("SELECT * FROM fx_sales WHERE NOT (year(data) = 2001 AND month(data) = 7)")
def delete_period(inputs: Inputs) -> DataFrame:
    return state.delete_period(inputs.view("fx_sales"), "data", 2001, 7)


@QUERIES.query("SELECT * FROM fx_master WHERE item_principal_cadeia IS NOT NULL")
def drop_null_keys(inputs: Inputs) -> DataFrame:
    return state.drop_null_keys(inputs.view("fx_master"), ["item_principal_cadeia"])


# --- type-2 history over three snapshots -----------------------------------------------

_MONTHS = (date(2001, 6, 1), date(2001, 7, 1), date(2001, 8, 1))


def snapshot(inputs: Inputs, i: int) -> DataFrame:
    return inputs.view(f"fx_snapshot_{i}").withColumn("row_hash", row_hash(["a", "b"]))


def history_of(inputs: Inputs, upto: int = 3) -> DataFrame:
    built = state.open_versions(snapshot(inputs, 1), state.HISTORY_START)
    for i in range(2, upto + 1):
        moment = _MONTHS[i - 1]
        stage = state.open_versions(snapshot(inputs, i), datetime(moment.year, moment.month, 1))
        built = state.scd2_apply(built, stage, ["k"], moment)
    return built


# Versions as runs of equal hashes over the snapshots in which a key occurs without a gap.
_HISTORY = """
    SELECT k, a, b, row_hash, start_date, CASE WHEN last < 3 THEN list_extract([TIMESTAMP '2001-06-01',
        TIMESTAMP '2001-07-01', TIMESTAMP '2001-08-01'], last + 1) END AS end_date, last = 3 AS is_current
    FROM (SELECT k, min(a) AS a, min(b) AS b, row_hash, CAST(max(m) AS INTEGER) AS last,
        list_extract([TIMESTAMP '1900-01-01', TIMESTAMP '2001-07-01', TIMESTAMP '2001-08-01'], CAST(min(m) AS INTEGER)) AS start_date
      FROM (SELECT *, m - row_number() OVER (PARTITION BY k, row_hash ORDER BY m) AS run FROM (
        SELECT *, sha256(concat_ws('||', coalesce(a, '<NULL>'), coalesce(b, '<NULL>'))) AS row_hash FROM (
          SELECT *, 1 AS m FROM fx_snapshot_1 UNION ALL SELECT *, 2 FROM fx_snapshot_2
          UNION ALL SELECT *, 3 FROM fx_snapshot_3)))
      GROUP BY k, row_hash, run)"""


@QUERIES.query(_HISTORY)
def scd2_apply(inputs: Inputs) -> DataFrame:
    return history_of(inputs)


@QUERIES.query("SELECT k, a, b FROM fx_snapshot_2")
def scd2_as_of(inputs: Inputs) -> DataFrame:
    return state.as_of(history_of(inputs), datetime(2001, 7, 15)).select("k", "a", "b")


@QUERIES.query(f"""
    SELECT k, count(*) AS versions, count_if(is_current) AS current_versions, min(start_date) AS first_start,
      max(start_date) AS last_start FROM ({_HISTORY}) GROUP BY k""")
def scd2_state(inputs: Inputs) -> DataFrame:
    return state.scd2_state(history_of(inputs), ["k"])


@QUERIES.query("""
    SELECT count_if(s.k IS NOT NULL AND o.a IS NOT DISTINCT FROM s.a AND o.b = s.b) AS unchanged,
      count_if(o.k IS NOT NULL AND s.k IS NOT NULL AND NOT (o.a IS NOT DISTINCT FROM s.a AND o.b = s.b)) AS changed,
      count_if(s.k IS NULL) AS missing, count_if(o.k IS NULL) AS added
    FROM fx_snapshot_1 o FULL JOIN fx_snapshot_2 s ON o.k = s.k""")
def scd2_counts(inputs: Inputs) -> DataFrame:
    return state.scd2_counts(history_of(inputs, 1), snapshot(inputs, 2), ["k"])


def _tracked(name: str) -> str:
    source = {"lead_time": "prazo_entrega_prevista_lead_time_firme"}.get(name, name)
    text = f"trim({source})"
    if name in ("data_cadeia", "cut_in_material", "cut_off_material"):
        text = _REPAIRED.format(c=text)
    return f"{text} AS {name}"


_STAGE = f"""
    SELECT *, sha256(concat_ws('||', {", ".join(f"coalesce({c}, '<NULL>')" for c in HISTORY_TRACKED)})) AS row_hash
    FROM (SELECT empresa, material, {", ".join(map(_tracked, HISTORY_TRACKED))} FROM fx_master
      WHERE tipo_de_material IN ('ZHAW', 'ZFER', 'ZRO1'))"""


@QUERIES.query(_STAGE)
def scd2_stage(inputs: Inputs) -> DataFrame:
    return history.history_stage(history.history_rows(inputs.view("fx_master")))


@QUERIES.query(f"""
    SELECT empresa, material, row_hash, TIMESTAMP '1900-01-01' AS start_date, true AS is_current, 'carga-1' AS _load_id
    FROM ({_STAGE})""")
def history_load(inputs: Inputs) -> DataFrame:
    """First load of the material history, gates included."""
    loaded = history.load_history(
        None, inputs.view("fx_master"), date(2001, 8, 1), {"_load_id": F.lit("carga-1")})
    return loaded.select(*HISTORY_KEYS, "row_hash", "start_date", "is_current", "_load_id")


@QUERIES.query(f"""
    SELECT h.k, h.a, h.b, s.extra, h.start_date, h.is_current,
      CASE WHEN h.is_current AND s.k IS NOT NULL
        THEN sha256(concat_ws('||', coalesce(s.a, '<NULL>'), coalesce(s.b, '<NULL>'), coalesce(s.extra, '<NULL>')))
        ELSE h.row_hash END AS row_hash
    FROM ({_HISTORY}) h LEFT JOIN (SELECT *, 'E' || b AS extra FROM fx_snapshot_3 WHERE CAST(k AS INTEGER) % 4 <> 0) s
      ON h.k = s.k AND h.is_current""")
def column_backfill(inputs: Inputs) -> DataFrame:
    stage = inputs.view("fx_snapshot_3").where("CAST(k AS INT) % 4 <> 0").withColumn(
        "extra", F.concat(F.lit("E"), F.col("b")))
    filled = state.backfill_column(history_of(inputs), stage, ["k"], "extra", ["a", "b", "extra"])
    return filled.select("k", "a", "b", "extra", "start_date", "is_current", "row_hash")


@QUERIES.query("""
    SELECT p_partkey, CAST(round_even(CAST(p_retailprice AS DECIMAL(38,6)), 2) AS DECIMAL(18,2)) AS p_retailprice FROM part""")
def decimal_migration(inputs: Inputs) -> DataFrame:
    return state.migrate_decimal(inputs.table("part").select("p_partkey", "p_retailprice"), "p_retailprice")


@QUERIES.query("""
    SELECT count(*) AS total_rows, count(v) AS non_null, count_if(v IS NOT NULL AND TRY_CAST(v AS DECIMAL(18,2)) IS NULL)
      AS invalid_casts, count_if(abs(v - round(v, 2)) > 1e-4) AS extra_decimals
    FROM (SELECT CASE WHEN l_linenumber = 7 THEN NULL WHEN l_linenumber = 6 THEN 1e18 + l_quantity
      ELSE l_extendedprice * l_discount / 8 END AS v FROM lineitem)""")
def decimal_migration_checks(inputs: Inputs) -> DataFrame:
    value = F.when(F.col("l_linenumber") == 7, F.lit(None)).when(
        F.col("l_linenumber") == 6, F.lit(1e18) + F.col("l_quantity")).otherwise(
        F.col("l_extendedprice") * F.col("l_discount") / 8)
    return state.decimal_migration_checks(inputs.table("lineitem").select(value.alias("v")), "v")


@QUERIES.query(f"""
    SELECT s.numero_ov, s.item, s.data, h.a, h.b FROM
      (SELECT numero_ov, item, data, CAST(emissor_da_ordem AS VARCHAR) AS cliente FROM fx_sales) s
    LEFT JOIN ({_HISTORY}) h ON s.cliente = h.k AND s.data >= h.start_date AND (h.end_date IS NULL OR s.data < h.end_date)""")
def sales_versions(inputs: Inputs) -> DataFrame:
    """Every sales row with the version of its customer that was valid on its day."""
    sales = inputs.view("fx_sales").select(
        "numero_ov", "item", "data", F.col("emissor_da_ordem").cast("string").alias("cliente"))
    return state.join_versions(sales, history_of(inputs), {"cliente": "k"}, "data", ["a", "b"]).drop("cliente")


@QUERIES.query(f"""
    SELECT * FROM (WITH o AS ({_STAGE}), s AS (SELECT * REPLACE (CASE WHEN material LIKE '%7' THEN 'nova' ELSE cadeia END AS cadeia) FROM ({_STAGE})
      WHERE material NOT LIKE '%5')
    SELECT count_if(o.material IS NOT NULL AND s.material IS NOT NULL AND o.cadeia IS NOT DISTINCT FROM s.cadeia) AS unchanged,
      count_if(o.material IS NOT NULL AND s.material IS NOT NULL AND o.cadeia IS DISTINCT FROM s.cadeia) AS changed,
      count_if(s.material IS NULL) AS missing, count_if(o.material IS NULL) AS added,
      (SELECT count(*) FROM o) + count_if(o.material IS NULL OR (s.material IS NOT NULL AND o.cadeia IS DISTINCT FROM s.cadeia)) AS versions
    FROM o FULL JOIN s ON o.empresa = s.empresa AND o.material = s.material)""")
def history_counts(inputs: Inputs) -> DataFrame:
    """The counts that the second load of a stored history returns from its writing pass, and the versions stored."""
    master = inputs.view("fx_master")
    folder = HistoryFolder(inputs.spark, scratch_path(inputs.spark, "history"))
    history.load_history_folder(folder, master, date(2001, 7, 1))
    second = master.where("material NOT LIKE '%5'").withColumn(
        "cadeia", F.when(F.col("material").like("%7"), F.lit("nova")).otherwise(F.col("cadeia")))
    counts = history.load_history_folder(folder, second, date(2001, 8, 1))
    return folder.read().agg(*[F.lit(n).cast("long").alias(name) for name, n in counts.items()], F.count(F.lit(1)).alias("versions"))

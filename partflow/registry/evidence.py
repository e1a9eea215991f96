"""Loads, deliveries and gates from end to end, over whole tables."""

from __future__ import annotations

from datetime import date

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partflow.config import HISTORY_KEYS, HISTORY_TRACKED, SEGMENTS
from partflow.functions import dates
from partflow.operators import joins, project, quality
from partflow.operators.aggregate import static_pivot, union_all
from partflow.plans import forecast, history
from partflow.registry.base import Family
from partflow.registry.fixtures import Inputs
from partflow.registry.forecast import Forecasts, prev_sql
from partflow.registry.state import _STAGE
from partflow.session import scratch_path
from partflow.sinks import export
from partflow.sinks.tables import TableFolder, child_folders, publish_segments
from partflow.sources import readers
from partflow.streaming import ingest

QUERIES = Family()

# --- sales files through the stream ----------------------------------------------------

# Every sales row as an order item of its own, with the file it comes in.
_ITEMS = """
    SELECT numero_ov, row_number() OVER (PARTITION BY numero_ov ORDER BY item NULLS FIRST, org_vendas NULLS FIRST, material NULLS FIRST,
        centro NULLS FIRST, canal_dist NULLS FIRST, setor_ativ NULLS FIRST, quantidade NULLS FIRST) AS item,
      data, tipo_ov, org_vendas, canal_dist, setor_ativ, emissor_da_ordem, material, quantidade,
      concat('salesorder_raw_', substring(CAST(data AS STRING), 1, 7), '_', org_vendas, '_',
        CASE org_vendas WHEN '0200' THEN '2W' ELSE '4W' END, '.txt') AS arquivo
    FROM fx_sales"""


def _send(rows: DataFrame, folder: str, moved: str | None = None) -> None:
    """The rows as text files under their names; with ``moved`` that file gets dates of another month."""
    spark, part = rows.sparkSession, scratch_path(rows.sparkSession, "files")
    day = F.when(F.col("arquivo") == moved, F.add_months("data", 1)).otherwise(F.col("data")) if moved else F.col("data")
    fields = [F.col("numero_ov"), F.date_format(day, "dd.MM.yyyy"), "tipo_ov", F.lit(""), F.lit(""), F.lit(""), "org_vendas", "canal_dist",
              "setor_ativ", F.lit("0203"), "emissor_da_ordem", F.lit("autor"), "item", "material", F.lit("TAN"), F.lit(""),
              F.replace(F.col("quantidade").cast("string"), F.lit("."), F.lit(",")), F.lit("PC")]
    texts = [F.coalesce((F.col(f) if isinstance(f, str) else f).cast("string"), F.lit("")) for f in fields]
    line = F.concat(F.lit("|"), F.concat_ws("|", *texts), F.lit("|"))
    rows.select(line.alias("value"), "arquivo").repartition("arquivo").write.partitionBy("arquivo").text(part)
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(path(folder))
    for written in fs.globStatus(path(part, "arquivo=*/part-*")):
        name = written.getPath().getParent().getName().removeprefix("arquivo=")
        fs.delete(path(folder, name), False)
        fs.rename(written.getPath(), path(folder, name))


@QUERIES.query(f"""
    SELECT numero_ov, item, data, tipo_ov, org_vendas, emissor_da_ordem, material, quantidade, arquivo, 'C2' AS carga,
      true AS do_arquivo FROM ({_ITEMS})""")
def sales_ingest(inputs: Inputs) -> DataFrame:
    """All sales as files of a month and organisation: a run that a gate stops, then one with the mended file."""
    spark, root = inputs.spark, scratch_path(inputs.spark, "sales_ingest")
    rows, now = inputs.sql(_ITEMS), F.lit("2001-09-01 00:00:00").cast("timestamp")
    first = rows.agg(F.min("arquivo")).first()[0]
    _send(rows, f"{root}/in", first)
    for check_first in (True, False):
        try:
            ingest.ingest_sales(spark, f"{root}/in", root, "C1", "me", now, check_first=check_first)
            raise ValueError("dates of another month should stop the load")
        except (PySparkException, quality.GateError) as error:
            if "file_period" not in str(error):
                raise
        if ingest.sales_state(spark, root).read() is not None or ingest.manifest_folder(spark, root).read() is not None:
            raise ValueError("a load that was stopped should leave nothing")
    _send(rows.where(F.col("arquivo") == first), f"{root}/in")
    state = ingest.ingest_sales(spark, f"{root}/in", root, "C2", "me", now).read()
    name = F.col("_source_file_name")
    return state.select(
        "numero_ov", F.col("item").cast("int").alias("item"), "data", "tipo_ov", "org_vendas", "emissor_da_ordem", "material",
        "quantidade", name.alias("arquivo"), F.col("_load_id").alias("carga"),
        (F.endswith("_source_file_path", F.concat(F.lit("/"), name)) & (
            F.col("_source_file_modification_time") <= F.current_timestamp())).alias("do_arquivo"))


# --- sources ---------------------------------------------------------------------------

@QUERIES.query("SELECT numero_ov, material, quantidade FROM fx_sales")
def read_folders(inputs: Inputs) -> DataFrame:
    """Parquet files in folders of different depth, read together."""
    rows = inputs.view("fx_sales").select("numero_ov", "material", "quantidade", "org_vendas")
    root = scratch_path(inputs.spark, "folders")
    rows.where("org_vendas = '0200'").drop("org_vendas").write.parquet(f"{root}/2w")
    rows.where("org_vendas <> '0200'").drop("org_vendas").write.parquet(f"{root}/4w/a/b")
    return readers.read_history(inputs.spark, root)


_NAMES = """
    SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN concat('CAD0203_', replace(substring(CAST(CAST(o_orderdate AS DATE) AS STRING), 1, 7), '-', '.'), '.csv')
      WHEN 1 THEN concat('CAD_', CAST(o_orderkey AS STRING), '.csv') ELSE 'CAD0503_2001.13.csv' END AS _source_file_name, CAST(o_orderdate AS DATE) AS dia
    FROM orders"""


@QUERIES.query(f"""
    SELECT o_orderkey, _source_file_name, CASE WHEN o_orderkey % 3 = 0 THEN CAST(date_trunc('month', dia) AS DATE) END AS reference_date
    FROM ({_NAMES})""")
def file_month(inputs: Inputs) -> DataFrame:
    """The month in a file's name; NULL where it has none or no real one."""
    return readers.with_reference_date(inputs.sql(_NAMES)).drop("dia")


@QUERIES.query("""SELECT c_name AS cliente, c_mktsegment AS segmento_x, CAST(c_custkey AS VARCHAR) AS cod FROM customer""")
def promote_header(inputs: Inputs) -> DataFrame:
    """All-text rows in which every file repeats its header."""
    rows = inputs.sql("""
        SELECT c_name AS _c0, c_mktsegment AS _c1, CAST(c_custkey AS STRING) AS _c2 FROM customer
        UNION ALL SELECT 'Cliente', 'Segmento X', 'Cód.' FROM nation""")
    return project.promote_header(rows, ["Cliente", "Segmento X", "Cód."])


@QUERIES.query("""
    SELECT tag, count(*) AS linhas FROM fx_sales JOIN (VALUES ('0200', 'HDA'), ('0500', 'HAB'), ('0700', 'XXX')) AS s(org, tag)
      ON org_vendas = org GROUP BY 1""")
def inline_lookup(inputs: Inputs) -> DataFrame:
    """Sales counted under names that are given as inline rows."""
    tags = readers.inline_rows(inputs.spark, [("0200", "HDA"), ("0500", "HAB"), ("0700", "XXX")], "org string, tag string")
    return joins.lookup_join(inputs.view("fx_sales"), tags, {"org_vendas": "org"}, "inner").groupBy("tag").agg(
        F.count(F.lit(1)).alias("linhas"))


@QUERIES.query("SELECT p_partkey, TRY_CAST(CASE WHEN texto = '' THEN NULL ELSE texto END AS DOUBLE) AS texto FROM fx_numbers")
def try_types(inputs: Inputs) -> DataFrame:
    return project.try_types(inputs.view("fx_numbers"), {"texto": "double"})


_TYPES = ("ZPUG", "ZESP", "ZNOR")


@QUERIES.query("""
    SELECT org_vendas, CAST(row_number() OVER (PARTITION BY org_vendas ORDER BY tipo_ov) AS INTEGER) AS posicao, tipo_ov AS coluna, n AS total
    FROM (SELECT org_vendas, tipo_ov, count(*) AS n FROM fx_sales WHERE tipo_ov IS NOT NULL GROUP BY ALL)""")
def ordered_columns(inputs: Inputs) -> DataFrame:
    """The columns of a pivot behind its keys in the order of their names, each with its place and value."""
    rows = inputs.view("fx_sales").where("tipo_ov IS NOT NULL").withColumn("um", F.lit(1).cast("long"))
    wide = project.order_columns(static_pivot(rows, ["org_vendas"], "tipo_ov", _TYPES, "um"), ["org_vendas"])
    cells = F.array(*[F.struct(F.lit(n).alias("posicao"), F.lit(c).alias("coluna"), F.col(f"`{c}`").alias("total"))
                      for n, c in enumerate(wide.columns) if n])
    return wide.select("org_vendas", F.explode(cells).alias("c")).select("org_vendas", "c.*")


@QUERIES.query("SELECT * EXCLUDE (_raw_load_id) FROM ox_refined")
def forecast_view(inputs: Inputs) -> DataFrame:
    """The published forecast as its readers see it, without audit columns."""
    now = F.lit("2001-09-01 00:00:00").cast("timestamp")
    return forecast.forecast_view(forecast.publish_refined(Forecasts(inputs).refined(), "L1", now, "me"))


@QUERIES.query(f"SELECT empresa, material, {', '.join(HISTORY_TRACKED)} FROM ({_STAGE})")
def history_view(inputs: Inputs) -> DataFrame:
    """The current versions of the material history as its readers see them."""
    loaded = history.load_history(None, inputs.view("fx_master"), date(2001, 8, 1), {"_load_id": F.lit("carga-1")})
    return history.history_view(loaded).where("is_current").select(*HISTORY_KEYS, *HISTORY_TRACKED)


# --- functions -------------------------------------------------------------------------

@QUERIES.query("SELECT event_id, ts - INTERVAL 3 HOUR AS local FROM events")
def local_time(inputs: Inputs) -> DataFrame:
    return inputs.table("events").select("event_id", dates.local_timestamp(F.col("ts")).alias("local"))


@QUERIES.query("SELECT o_orderkey, strftime(o_orderdate, '%d/%m/%Y') AS dia FROM orders")
def day_label(inputs: Inputs) -> DataFrame:
    return inputs.table("orders").select("o_orderkey", dates.day_label(F.col("o_orderdate")).alias("dia"))


@QUERIES.query("SELECT event_id, ts FROM events")
def millis_and_back(inputs: Inputs) -> DataFrame:
    rows = inputs.table("events").select("event_id", F.date_trunc("second", "ts").alias("s"), "ts")
    back = dates.from_millis(dates.to_millis(F.col("s")))
    return rows.select("event_id", (back + (F.col("ts") - F.col("s"))).alias("ts"))


# --- tables and deliveries -------------------------------------------------------------

@QUERIES.query("SELECT material, CAST(count(*) AS BIGINT) AS linhas, CAST(2 AS BIGINT) AS versoes FROM fx_sales GROUP BY 1")
def table_schemas(inputs: Inputs) -> DataFrame:
    """A table replaced by one with other columns; the former version can still be read."""
    table = TableFolder(inputs.spark, scratch_path(inputs.spark, "schemas"))
    rows = inputs.view("fx_sales")
    table.replace(rows.select("numero_ov", "material"))
    table.replace(rows.groupBy("material").agg(F.count(F.lit(1)).alias("linhas")))
    if table.read().columns != ["material", "linhas"] or table.read(0).columns != ["numero_ov", "material"]:
        raise ValueError("every version should keep its own columns")
    return table.read().withColumn("versoes", F.lit(table.version() + 1).cast("long"))


@QUERIES.query("""
    SELECT 'uma' AS forma, CASE org_vendas WHEN '0200' THEN 'HDA' ELSE 'HAB' END AS segmento, count(*) AS linhas FROM fx_sales GROUP BY 2
    UNION ALL SELECT 'muitas', CASE org_vendas WHEN '0200' THEN 'HDA' ELSE 'HAB' END, count(*) FROM fx_sales GROUP BY 2""")
def segment_tables(inputs: Inputs) -> DataFrame:
    """One table with a segment column, and one table per segment."""
    spark, root = inputs.spark, scratch_path(inputs.spark, "segments")
    rows = inputs.view("fx_sales").select("org_vendas", "numero_ov", "material")
    publish_segments(spark, root, "vendas", rows, "tabela_unica")
    one = TableFolder(spark, f"{root}/vendas", {"segmento": "string"}).read().select(F.lit("uma").alias("forma"), "segmento")
    names = publish_segments(spark, root, "vendas", rows)
    each = [TableFolder(spark, f"{root}/{name}").read().select(F.lit("muitas").alias("forma"), F.lit(name[-3:]).alias("segmento"))
            for name in names]
    return union_all([one, *each]).groupBy("forma", "segmento").agg(F.count(F.lit(1)).alias("linhas"))


_PATHS = """SELECT CASE p_partkey % 4 WHEN 0 THEN concat('../', p_name) WHEN 1 THEN concat(p_brand, '/', p_name)
    ELSE p_name END AS file FROM part"""


@QUERIES.query(f"""SELECT DISTINCT 'file_path' AS rule, file AS subject, 'must not hold / or ..' AS detail FROM ({_PATHS})
    WHERE contains(file, '/') OR contains(file, '..')""")
def gate_file_paths(inputs: Inputs) -> DataFrame:
    return export.gate_file_paths(inputs.sql(_PATHS))


_SLICES = [(wheels, canal) for wheels in ("2W - Motos", "4W - Automóveis") for canal in ("Doméstico", "Exportação", None)]


@QUERIES.query("\nUNION ALL ".join(
    f"""SELECT '{"Forecast N-1 " + wheels[:2] + (" " + canal if canal else "")} 2001-05' AS entrega, * FROM (
      SELECT * {"" if canal else "REPLACE (ciclo AS ciclo), CAST(NULL AS VARCHAR) AS canal"} FROM ({prev_sql(bool(canal))}))
      WHERE segmento = '{wheels}'""" + (f" AND canal = '{canal}'" if canal else "") for wheels, canal in _SLICES).replace(
          "UNION ALL", "UNION ALL BY NAME"))
def forecast_prev_slices(inputs: Inputs) -> DataFrame:
    """The six deliveries of the previous cycle, side by side."""
    f = Forecasts(inputs)
    slices = forecast.forecast_prev_slices(f.raw, f.chain)
    return union_all([df.withColumn("entrega", F.lit(name)) for name, df in slices.items()])


# --- gates -----------------------------------------------------------------------------

@QUERIES.query("""
    SELECT DISTINCT 'file_empty' AS rule, 'salesorder_raw_' || strftime(data, '%Y-%m') || '_0500_4W.txt' AS subject,
      'no valid row after parsing' AS detail FROM fx_sales""")
def gate_empty_files(inputs: Inputs) -> DataFrame:
    """Files of both organisations of every month, of which those of one have no rows."""
    rows = inputs.sql(f"SELECT arquivo AS _source_file_name, data, org_vendas FROM ({_ITEMS}) WHERE org_vendas = '0200'")
    names = [F.concat(F.lit("salesorder_raw_"), F.date_format("data", "yyyy-MM"), F.lit(f"_{s.org}_{s.wheels}.txt")) for s in SEGMENTS.values()]
    files = inputs.view("fx_sales").select(F.explode(F.array(*names)).alias("file")).distinct()
    return quality.sales_file_gates(quality.file_stats(rows), files)


@QUERIES.query("""
    SELECT 'columns' AS rule, 'centro_novo, um' AS subject, 'missing' AS detail FROM fx_sales HAVING count(*) > 0
    UNION ALL SELECT 'type', 'quantidade', 'decimal(18,3) is not double' FROM fx_sales HAVING count(*) > 0
    UNION ALL SELECT 'empty', 'vendas', 'no rows' FROM fx_sales WHERE quantidade < 0 HAVING count(*) = 0""")
def gate_tables(inputs: Inputs) -> DataFrame:
    """Columns that are missing, one of another type, and a selection without rows."""
    rows = inputs.view("fx_sales")
    return union_all([
        quality.gate_columns(rows, ["numero_ov", "centro_novo", "material", "um"]), quality.gate_type(rows, "quantidade", "double"),
        quality.gate_type(rows, "data", "date"), quality.gate_not_empty(rows.where("quantidade < 0"), "vendas"),
        quality.gate_not_empty(rows, "tudo")])


@QUERIES.query("SELECT 'key' AS rule, CAST(count(*) AS VARCHAR) AS violacoes, CAST(least(count(*), 100) AS VARCHAR) AS listadas "
               "FROM fx_master WHERE item_principal_cadeia IS NULL OR trim(item_principal_cadeia) = ''")
def gate_sample(inputs: Inputs) -> DataFrame:
    """A failed gate stores all violations, counts them and lists the first hundred."""
    try:
        quality.enforce(quality.gate_keys(inputs.view("fx_master"), ["empresa", "item_principal_cadeia"]))
    except quality.GateError as error:
        stored = inputs.spark.read.parquet(error.path)
        return stored.groupBy("rule").agg(F.count(F.lit(1)).cast("string").alias("violacoes")).withColumn(
            "listadas", F.lit(str(len(error.violations))))
    raise ValueError("keys that are empty should stop the load")

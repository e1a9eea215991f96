"""Queries that write files to the shared folder, or stream from files, and read them back."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partflow.operators.state import dedupe_latest
from partflow.plans import inventory
from partflow.registry.base import Family
from partflow.registry.fixtures import ANCHOR, Inputs
from partflow.session import scratch_path
from partflow.sinks import export
from partflow.sinks.tables import BatchFolder, TableFolder
from partflow.sources.readers import read_lines, read_lines_stream, read_tabular_strings
from partflow.streaming.ingest import manifest_folder, paths_of, run_available, stream_versions, upsert_batches

QUERIES = Family()


@QUERIES.query("""
    SELECT user_id, event_id, ts, event_type, value FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1""")
def stream_upsert(inputs: Inputs) -> DataFrame:
    """Events as a file stream; the newest event per user stays."""
    spark, root = inputs.spark, scratch_path(inputs.spark, "stream_upsert")
    schema = inputs.table("events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(inputs.folder)
    state = BatchFolder(spark, f"{root}/state", ["user_id"])
    run_available(
        stream.select("user_id", "event_id", "ts", "event_type", "value"),
        upsert_batches(state, ["event_id"]), f"{root}/checkpoint")
    return state.read()


#: A file of the stream holds some so many lines, so no task writes more as the table grows.
LINES_A_FILE = 500_000


def files_per_batch(lines: int) -> int:
    """Files of each of three batches."""
    return max(1, -(-lines // (3 * LINES_A_FILE)))


@QUERIES.query("SELECT DISTINCT value, true AS com_arquivo FROM fx_lines WHERE trim(value) <> ''")
def stream_lines(inputs: Inputs) -> DataFrame:
    """Text files as a stream of several batches with their lineage, and a second run that finds nothing new."""
    spark, root = inputs.spark, scratch_path(inputs.spark, "stream_lines")
    a_batch = files_per_batch(inputs.table("lineitem").count())
    inputs.view("fx_lines").repartition(3 * a_batch).write.option("lineSep", "\n").mode("overwrite").text(f"{root}/in")
    state = BatchFolder(spark, f"{root}/state", ["value"])
    for _ in range(2):
        lines = read_lines_stream(spark, f"{root}/in", files_per_batch=a_batch).where("trim(value) <> ''")
        run_available(lines.select("value", "_source_file_name"), upsert_batches(state, ["_source_file_name"]), f"{root}/checkpoint")
    if len(state.batches()) < 2:
        raise ValueError("the stream should come in several batches")
    state.compact()
    return state.read().select("value", F.col("_source_file_name").isNotNull().alias("com_arquivo"))


_STEPS = "CASE WHEN event_id % 7 < 3 THEN 0 WHEN event_id % 7 < 5 THEN 1 ELSE 2 END"


@QUERIES.query(f"""
    SELECT user_id, event_id, ts, event_type, value FROM (SELECT *, {_STEPS} AS passo FROM events) WHERE passo > 0
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY passo DESC, event_id DESC) = 1""")
def load_modes(inputs: Inputs) -> DataFrame:
    """One keyed state: an incremental batch, a refresh, an incremental batch, then all three replayed in another order."""
    spark = inputs.spark
    state = BatchFolder(spark, scratch_path(spark, "load_modes"), ["user_id"], ["event_id"])
    rows = inputs.sql(f"SELECT user_id, event_id, ts, event_type, value, {_STEPS} AS passo FROM events")
    load = upsert_batches(state, ["event_id"], refresh=[1])
    for step in (0, 1, 2, 1, 2, 0):
        load(rows.where(F.col("passo") == step).drop("passo"), step)
    if (state.batches(), state.refreshes()) != ([0, 1, 2], [1]):
        raise ValueError("a replayed batch should stand where it stood")
    return state.read()


def _named_text(rows: DataFrame, folder: str, name: str) -> None:
    """One text file under a given name, in place of what has it."""
    spark, part = rows.sparkSession, scratch_path(rows.sparkSession, "part")
    rows.coalesce(1).write.text(part)
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    written = next(s.getPath() for s in fs.listStatus(path(part)) if s.getPath().getName().startswith("part-"))
    fs.mkdirs(path(folder))
    fs.delete(path(folder, name), False)
    fs.rename(written, path(folder, name))


@QUERIES.query("""
    SELECT chave, valor, arquivo, CAST(lote AS BIGINT) AS lote FROM (
      SELECT concat('u', user_id) AS chave, event_type AS valor, CASE WHEN user_id % 2 = 0 THEN 'a.txt' ELSE 'b.txt' END AS arquivo,
        CASE WHEN user_id % 2 = 0 THEN 1 ELSE 0 END AS lote
      FROM events WHERE user_id % 2 = 1 OR event_id % 3 = 0
      QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1
      UNION ALL
      SELECT concat('u', user_id), event_type, 'a.txt', 0 FROM events
      WHERE user_id % 2 = 0 AND user_id NOT IN (SELECT user_id FROM events WHERE event_id % 3 = 0)
      QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1)""")
def stream_resent(inputs: Inputs) -> DataFrame:
    """Two files as a stream; one is sent again under its name between two runs, and its second content wins by key."""
    spark, root = inputs.spark, scratch_path(inputs.spark, "stream_resent")
    rows = dedupe_latest(inputs.table("events").select("user_id", "event_id", "event_type"), ["user_id"], ["event_id"])
    again = dedupe_latest(inputs.table("events").where("event_id % 3 = 0").select("user_id", "event_id", "event_type"),
                          ["user_id"], ["event_id"])
    state = BatchFolder(spark, f"{root}/state", ["chave"])
    manifest = manifest_folder(spark, root)

    def load(versions: DataFrame, batch_id: int) -> None:
        parts = F.split("value", ";")
        state.write_batch(read_lines(spark, paths_of(versions)).select(
            parts[0].alias("chave"), parts[1].alias("valor"), F.col("_source_file_name").alias("arquivo"),
            F.lit(batch_id).cast("long").alias("lote")), batch_id)

    def send(df: DataFrame, name: str) -> None:
        _named_text(df.select(F.concat_ws(";", F.concat(F.lit("u"), "user_id"), "event_type").alias("value")), f"{root}/in", name)

    send(rows.where("user_id % 2 = 0"), "a.txt")
    send(rows.where("user_id % 2 = 1"), "b.txt")
    stream_versions(spark, f"{root}/in", root, manifest, load)
    time.sleep(1.1)  # file systems may keep whole seconds
    send(again.where("user_id % 2 = 0"), "a.txt")
    for _ in range(2):
        stream_versions(spark, f"{root}/in", root, manifest, load)
    return state.read()


@QUERIES.query("""
    SELECT material, CAST(sum(quantidade) AS DECIMAL(38,3)) AS quantidade, count(*) AS linhas, sum(extra) AS extra FROM (
      SELECT material, quantidade, NULL AS extra FROM fx_sales UNION ALL
      SELECT material, quantidade, NULL FROM fx_sales WHERE tipo_ov = 'ZPUG' UNION ALL
      SELECT material, quantidade, 1 FROM fx_sales WHERE tipo_ov = 'ZESP') GROUP BY 1""")
def table_appends(inputs: Inputs) -> DataFrame:
    """A replaced table with two appends, the second with one more column."""
    table = TableFolder(inputs.spark, scratch_path(inputs.spark, "appends"))
    rows = inputs.view("fx_sales").select("material", "quantidade", "tipo_ov")
    table.replace(rows)
    table.append(rows.where("tipo_ov = 'ZPUG'"))
    table.append(rows.where("tipo_ov = 'ZESP'").withColumn("extra", F.lit(1)))
    return table.read().groupBy("material").agg(
        F.sum("quantidade").cast("decimal(38,3)").alias("quantidade"), F.count(F.lit(1)).alias("linhas"), F.sum("extra").alias("extra"))


@QUERIES.query("""
    SELECT 'clientes' AS tabela, 'C-' || PS AS file, RG AS sheet FROM fx_customer GROUP BY ALL
    UNION ALL SELECT 'areas', 'areas', NULL FROM (SELECT 1 FROM fx_area LIMIT 1)""")
def export_plan(inputs: Inputs) -> DataFrame:
    sheets = inputs.view("fx_customer").select(
        F.concat(F.lit("C-"), F.col("PS")).alias("file"), F.col("RG").alias("sheet"), "CLIENTE")
    return export.export_plan({"clientes": sheets, "areas": inputs.view("fx_area")})


@QUERIES.query("""
    SELECT org_vendas AS file, centro AS sheet, count(*) AS linhas, CAST(1000000 AS BIGINT) AS limite,
      count(*) > 1000000 AS excede FROM fx_sales GROUP BY 1, 2""")
def sheet_size(inputs: Inputs) -> DataFrame:
    rows = inputs.view("fx_sales").select(
        F.col("org_vendas").alias("file"), F.col("centro").alias("sheet"), "material", "quantidade")
    return export.sheet_size_report(rows)


_SHEETS = """
    SELECT p_type AS file, CASE WHEN p_partkey % 3 = 0 THEN concat(p_name, ': ', p_brand, '/[', p_type, ']*? continued')
      WHEN p_partkey % 3 = 1 THEN concat(p_name, CAST(p_size % 4 AS STRING)) ELSE 'TTL' END AS sheet FROM part"""


@QUERIES.query(f"""
    SELECT file, sheet, CASE WHEN again = 1 THEN nome ELSE left(nome, 28) || '_' || (row_number() OVER (
        PARTITION BY file, left(nome, 28), again > 1 ORDER BY upper(sheet) <> 'TTL', sheet) + 1) END AS nome,
      CAST(row_number() OVER (PARTITION BY file ORDER BY upper(sheet) <> 'TTL', sheet) AS INTEGER) AS posicao
    FROM (SELECT *, row_number() OVER (PARTITION BY file, nome ORDER BY upper(sheet) <> 'TTL', sheet) AS again
      FROM (SELECT DISTINCT file, sheet, left(trim(regexp_replace(sheet, '[\\[\\]:*?/\\\\]', '-', 'g'), ''''), 31) AS nome
        FROM ({_SHEETS})))""")
def sheet_names(inputs: Inputs) -> DataFrame:
    return export.safe_sheet_names(inputs.sql(_SHEETS))


_CELLS = """
    SELECT event_id, CASE event_id % 9 WHEN 0 THEN concat('=', event_type) WHEN 1 THEN concat('-', props)
      WHEN 2 THEN concat('@', event_type) WHEN 3 THEN concat('+', event_type) WHEN 4 THEN concat(chr(9), event_type)
      WHEN 5 THEN concat(chr(13), event_type) WHEN 6 THEN concat(event_type, '=1') WHEN 7 THEN concat(event_type, chr(1), chr(31), 'x')
      ELSE NULL END AS texto FROM events"""


@QUERIES.query(f"""SELECT event_id, CASE WHEN event_id % 9 < 6 THEN '''' || texto ELSE replace(replace(texto, chr(1), ''), chr(31), '') END AS texto
    FROM ({_CELLS})""")
def sanitize_cells(inputs: Inputs) -> DataFrame:
    return export.sanitize_cells(inputs.sql(_CELLS))


@QUERIES.query("SELECT numero_ov::VARCHAR AS numero_ov, item::VARCHAR AS item, org_vendas, centro, material FROM fx_sales")
def csv_roundtrip(inputs: Inputs) -> DataFrame:
    """Delivered with ``;`` and read back as texts, leading zeros and all."""
    path = scratch_path(inputs.spark, "csv")
    export.export_csv(inputs.view("fx_sales").select("numero_ov", "item", "org_vendas", "centro", "material"),
                      path, sep=";")
    return read_tabular_strings(inputs.spark, path, sep=";")


@QUERIES.query("""
    SELECT file, coalesce(sheet, 'sem centro') AS sheet, count(*) AS linhas, count(DISTINCT material) AS materiais
    FROM (SELECT CASE org_vendas WHEN '0200' THEN 'HDA 2001' ELSE 'HAB 2001' END AS file, centro AS sheet, material FROM fx_sales)
    GROUP BY 1, 2""")
def sheets_roundtrip(inputs: Inputs) -> DataFrame:
    """Delivered as one folder per file and sheet and counted from there."""
    path = scratch_path(inputs.spark, "sheets")
    rows = inputs.view("fx_sales").select(
        F.when(F.col("org_vendas") == "0200", "HDA 2001").otherwise("HAB 2001").alias("file"),
        F.coalesce("centro", F.lit("sem centro")).alias("sheet"), "material", "quantidade")
    export.export_sheets(rows, path)
    # The folder names are codes, so the columns get their type from the schema.
    back = inputs.spark.read.option("header", True).schema(
        "material string, quantidade string, file string, sheet string").csv(path)
    return back.groupBy("file", "sheet").agg(
        F.count(F.lit(1)).alias("linhas"), F.count_distinct("material").alias("materiais"))


@QUERIES.query("""
    SELECT empresa, centro, reference_date, count(*) AS linhas, CAST(sum(estoque_total) AS DECIMAL(38,2)) AS total FROM (
      SELECT empresa, centro, DATE '2001-07-01' AS reference_date, estoque_total FROM ox_inventory
      UNION ALL SELECT empresa, centro, DATE '2001-08-01', estoque_total FROM ox_inventory WHERE centro NOT LIKE '%5'
      UNION ALL SELECT empresa, centro, DATE '2001-08-01', 0 FROM ox_inventory WHERE centro LIKE '%5' AND estoque_total > 2000)
    GROUP BY 1, 2, 3""")
def inventory_table(inputs: Inputs) -> DataFrame:
    """Two months of snapshots, then a partial reload of one centre per company."""
    spark = inputs.spark
    table = TableFolder(spark, scratch_path(spark, "inventory"), {
        "reference_date": "date", "empresa": "string", "centro": "string"})
    rows = inventory.inventory_rows(inputs.view("fx_stock"), ANCHOR)
    table.replace(rows.withColumn("reference_date", F.lit("2001-07-01").cast("date")))
    table.replace_scopes(rows)
    partial = rows.where("centro LIKE '%5' AND estoque_total > 2000")
    table.replace_scopes(partial.withColumn("estoque_total", F.lit(0).cast("decimal(18,2)")))
    return table.read().groupBy("empresa", "centro", "reference_date").agg(
        F.count(F.lit(1)).alias("linhas"), F.sum("estoque_total").cast("decimal(38,2)").alias("total"))

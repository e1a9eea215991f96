"""Sources, sinks and streaming against real files."""

import os
import time
from datetime import date

import pytest
from pyspark.sql import functions as F

from partflow.operators.quality import GateError, file_stats, sales_file_gates
from partflow.plans import materials
from partflow.plans.sales import parse_sales
from partflow.registry import files
from partflow.registry.fixtures import Inputs
from partflow.sinks import export
from partflow.sinks.tables import BatchFolder, TableFolder, annotate, publish_segments
from partflow.sources import readers
from partflow.streaming import ingest



@pytest.fixture
def now(spark):
    return F.lit("2026-11-01 10:00:00").cast("timestamp")


def line(order, day, org, item=10, qty="1,000", material="M1"):
    return f"|{order}|{day}|ZNOR||||{org}|01|04|0203|77|a|{item}|{material}|TAN||{qty}|PC|"


def write(folder, name, lines, at=None):
    folder.mkdir(parents=True, exist_ok=True)
    path = folder / name
    path.write_text("\n".join(lines) + "\n")
    if at is not None:
        os.utime(path, (at, at))
    return path


def month_files(folder, period="2026-10", at=None, qty="1,000"):
    day = f"05.{period[5:]}.{period[:4]}"
    for org, seg in (("0200", "2W"), ("0500", "4W")):
        write(folder, f"salesorder_raw_{period}_{org}_{seg}.txt",
              ["Doc.|Data" + "|" * 16, "", line(1, day, org, 10 if org == "0200" else 20, qty)], at)


def test_parse_rejects_bad_lines(spark):
    good = line(1, "05.10.2026", "0200", qty="12,500-")
    bad = ["", "   ", "|1|05.10.2026|x", "Doc.|05.10.2026" + "|x" * 16, line(2, "2026-10-05", "0200"),
           line(3, "05.10.2026", "0200", material="A|B"), good.strip("|").rsplit("|", 1)[0] + "|"]
    df = spark.createDataFrame([(x,) for x in [good, good.strip("|"), *bad]], "value string")
    got = parse_sales(df).collect()
    assert len(got) == 2 and got[0] == got[1]
    assert (got[0].numero_ov, got[0].data, float(got[0].quantidade), got[0].motivo_ov) == (1, date(2026, 10, 5), -12.5, None)


def test_stream_ingest_is_idempotent(spark, tmp_path, now):
    folder, root = tmp_path / "in", str(tmp_path / "out")
    month_files(folder)
    state = ingest.ingest_sales(spark, str(folder), root, "L1", "me", now)
    first = state.read().count()
    assert first == 2 and state.batches() == [0]
    ingest.ingest_sales(spark, str(folder), root, "L2", "me", now)
    assert state.batches() == [0] and state.read().count() == 2
    month_files(folder, "2026-11")
    ingest.ingest_sales(spark, str(folder), root, "L3", "me", now)
    state.compact()
    assert state.compacted() == state.batches()[-1]
    got = state.read()
    assert {r._load_id for r in got.collect()} == {"L3"}  # same keys, newer files
    assert got.count() == 2


def test_failed_gate_writes_nothing(spark, tmp_path, now):
    folder, root = tmp_path / "in", str(tmp_path / "out")
    write(folder, "salesorder_raw_2026-10_0200_2W.txt", [line(1, "05.10.2026", "0200")])
    with pytest.raises(Exception, match="file_missing"):
        ingest.ingest_sales(spark, str(folder), root, "L1", "me", now)
    state = ingest.sales_state(spark, root)
    assert state.read() is None and state.batches() == []
    write(folder, "salesorder_raw_2026-10_0500_4W.txt", [line(2, "05.10.2026", "0500")])
    assert ingest.ingest_sales(spark, str(folder), root, "L2", "me", now).read().count() == 2


def test_missing_org_may_be_loaded_already(spark, tmp_path, now):
    folder, root = tmp_path / "in", str(tmp_path / "out")
    month_files(folder)
    ingest.ingest_sales(spark, str(folder), root, "L1", "me", now)
    late = tmp_path / "late"
    write(late, "salesorder_raw_2026-10_0200_2W.txt", [line(9, "07.10.2026", "0200")])
    loaded = ingest.sales_state(spark, root).read()
    assert ingest.preflight(spark, str(late), None, loaded)
    with pytest.raises(GateError, match="file_missing"):
        ingest.preflight(spark, str(late), None, None)


def quantities(spark, root):
    return {float(r.quantidade) for r in ingest.sales_state(spark, root).read().collect()}


@pytest.mark.parametrize("load", [ingest.ingest_sales, ingest.ingest_new_files])
def test_resent_file_is_taken_again(spark, tmp_path, now, load):
    folder, root = tmp_path / "in", str(tmp_path / "out")
    old = time.time() - 1000
    month_files(folder, at=old)
    load(spark, str(folder), root, "L1", "me", now)
    load(spark, str(folder), root, "L2", "me", now)
    assert ingest.sales_state(spark, root).batches() == [0] and quantities(spark, root) == {1.0}
    month_files(folder, at=old + 500, qty="7,000")
    load(spark, str(folder), root, "L3", "me", now)
    assert quantities(spark, root) == {7.0} and ingest.sales_state(spark, root).read().count() == 2
    # Sent again with an older content and time: nothing happens.
    month_files(folder, at=old + 100, qty="3,000")
    load(spark, str(folder), root, "L4", "me", now)
    assert quantities(spark, root) == {7.0}


def test_failed_batch_takes_the_mended_file(spark, tmp_path, now):
    folder, root = tmp_path / "in", str(tmp_path / "out")
    old = time.time() - 1000
    month_files(folder, at=old)
    good = (folder / "salesorder_raw_2026-10_0500_4W.txt").read_text()
    write(folder, "salesorder_raw_2026-10_0500_4W.txt", [line(1, "05.11.2026", "0500")], old)
    for _ in range(2):
        with pytest.raises(Exception, match="file_period"):
            ingest.ingest_sales(spark, str(folder), root, "L1", "me", now)
        assert ingest.sales_state(spark, root).read() is None
    write(folder, "salesorder_raw_2026-10_0500_4W.txt", good.splitlines(), old + 10)
    state = ingest.ingest_sales(spark, str(folder), root, "L2", "me", now)
    assert state.batches() == [0] and state.read().count() == 2
    with pytest.raises(GateError, match="file_empty"):
        write(folder, "salesorder_raw_2026-11_0200_2W.txt", [""])
        ingest.ingest_sales(spark, str(folder), root, "L3", "me", now, check_first=True)
    assert state.read().count() == 2


def test_refresh_opens_a_generation(spark, tmp_path, now):
    folder, root = tmp_path / "in", str(tmp_path / "out")
    old = time.time() - 1000
    month_files(folder, at=old)
    ingest.ingest_sales(spark, str(folder), root, "L1", "me", now)
    write(folder, "salesorder_raw_2026-11_0200_2W.txt", [line(5, "05.11.2026", "0200")], old + 1)
    # Rows in place do not stand in for the other organisation: they are about to go.
    with pytest.raises(Exception, match="file_missing"):
        ingest.ingest_sales(spark, str(folder), root, "L2", "me", now, mode="PERIOD_REFRESH")
    write(folder, "salesorder_raw_2026-11_0500_4W.txt", [line(6, "05.11.2026", "0500")], old + 1)
    state = ingest.ingest_sales(spark, str(folder), root, "L2", "me", now, mode="PERIOD_REFRESH")
    assert sorted(r.numero_ov for r in state.read().collect()) == [5, 6] and state.refreshes() == [1]
    assert {r._load_type for r in state.read().collect()} == {"PERIOD_REFRESH"}
    month_files(folder, "2026-12", at=old + 2)
    ingest.ingest_sales(spark, str(folder), root, "L3", "me", now)
    assert sorted(r.numero_ov for r in state.read().collect()) == [1, 1, 5, 6]
    assert state.rows().count() == 4 and state.pending() == 3
    state.compact()
    assert state.read().count() == 4 and state.pending() == 0
    with pytest.raises(ValueError, match="mode"):
        ingest.ingest_sales(spark, str(folder), str(tmp_path / "x"), "L4", "me", now, mode="ALL")


def test_batch_generations(spark, tmp_path):
    state = BatchFolder(spark, str(tmp_path / "s"), ["k"], ["t"])

    def rows(*pairs):
        return spark.createDataFrame([(k, t, f"{k}-{t}") for k, t in pairs], "k int, t int, v string")

    def found():
        return sorted(r.v for r in state.read().collect())

    state.write_batch(rows((1, 1), (1, 9), (2, 1)), 0)
    assert found() == ["1-9", "2-1"]
    state.stage(rows((3, 1)), 1)
    assert found() == ["1-9", "2-1"] and state.batches() == [0]
    state.publish(1, refresh=True)
    state.write_batch(rows((3, 0), (4, 1)), 2)
    assert found() == ["3-0", "4-1"]
    for again in (0, 2):  # replays, one from before the refresh
        state.write_batch(rows((3, 0), (4, 1)) if again else rows((1, 1), (1, 9), (2, 1)), again)
        assert found() == ["3-0", "4-1"]
    state.stage(rows((3, 1)), 1)
    state.publish(1, refresh=True)
    assert found() == ["3-0", "4-1"]
    assert sorted(r.v for r in state.read(before=2).collect()) == ["3-1"] and state.read(before=0) is None
    with pytest.raises(ValueError, match="stored as refresh"):
        state.write_batch(rows((5, 1)), 1)
    state.compact()
    with pytest.raises(ValueError, match="compacted"):
        state.write_batch(rows((5, 1)), 2)
    state.write_batch(rows((4, 0)).withColumn("extra", F.lit(1)), 3)
    assert found() == ["3-0", "4-0"]
    state.write_batch(rows((7, 7)), 4, refresh=True)
    assert found() == ["7-7"]


@pytest.mark.parametrize("name, lines, rule", [
    ("sales_2026-10.txt", [line(1, "05.10.2026", "0200")], "file_name"),
    ("salesorder_raw_2026-10_0700_2W.txt", [line(1, "05.10.2026", "0700")], "file_org"),
    ("salesorder_raw_2026-10_0200_4W.txt", [line(1, "05.10.2026", "0200")], "file_org"),
    ("salesorder_raw_2026-10_0200_2W.txt", [""], "file_empty"),
    ("salesorder_raw_2026-10_0200_2W.txt", [line(1, "05.11.2026", "0200")], "file_period"),
    ("salesorder_raw_2026-10_0200_2W.txt", [line(1, "99.10.2026", "0200")], "file_null_dates"),
    ("salesorder_raw_2026-10_0200_2W.txt", [line(1, "05.10.2026", "0500")], "file_content_org"),
])
def test_file_rules(spark, tmp_path, name, lines, rule):
    write(tmp_path, name, lines)
    rows = readers.read_lines(spark, str(tmp_path))
    # An empty text file has no rows, so the list of files comes from the folder.
    files = ingest.pending_files(spark, str(tmp_path), None).select("file")
    found = {r.rule for r in sales_file_gates(file_stats(parse_sales(rows)), files).collect()}
    assert rule in found


def test_two_files_for_one_period(spark):
    files = spark.createDataFrame([(f"salesorder_raw_2026-10_0200_{s}.txt",) for s in ("2W", "3W")], "file string")
    stats = spark.createDataFrame([], "file string, rows bigint, null_dates bigint, min_period string, "
                                      "max_period string, min_org string, max_org string")
    found = {(r.rule, r.subject) for r in sales_file_gates(stats, files).collect()}
    assert ("file_repeated", "2026-10 0200") in found and ("file_missing", "2026-10 0500") in found


def test_table_folder(spark, tmp_path):
    table = TableFolder(spark, str(tmp_path / "t"), {"mes": "date", "empresa": "string"}, evolving=True)
    rows = spark.sql("SELECT DATE '2026-10-01' AS mes, '0200' AS empresa, 1 AS q UNION ALL "
                     "SELECT DATE '2026-10-01', '0500', 2 UNION ALL SELECT DATE '2026-11-01', '0200', 3")
    table.replace(rows)
    table.replace_scopes(spark.sql("SELECT DATE '2026-10-01' AS mes, '0200' AS empresa, 9 AS q"))
    got = {(str(r.mes), r.empresa): r.q for r in table.read().collect()}
    assert got == {("2026-10-01", "0200"): 9, ("2026-10-01", "0500"): 2, ("2026-11-01", "0200"): 3}
    table.append(spark.sql("SELECT DATE '2026-12-01' AS mes, '0200' AS empresa, 4 AS q, 'new' AS extra"))
    assert "extra" in table.read().columns and table.read().where("extra IS NULL").count() == 3
    table.replace(rows.limit(1))
    assert table.version() == 1 and table.read().count() == 1 and table.read(0).count() == 4


def test_unfinished_version_is_not_read(spark, tmp_path):
    table = TableFolder(spark, str(tmp_path / "t"))
    table.replace(spark.range(3))
    (tmp_path / "t" / "v=1").mkdir()
    assert table.version() == 0 and table.read().count() == 3


def test_publish_segments(spark, tmp_path):
    df = spark.createDataFrame([("0200", 1), ("0500", 2), ("0500", 3)], "org_vendas string, q int")
    assert publish_segments(spark, str(tmp_path), "d", df) == ["d_HDA", "d_HAB"]
    assert TableFolder(spark, f"{tmp_path}/d_HAB").read().count() == 2
    publish_segments(spark, str(tmp_path), "one", df, "tabela_unica")
    one = TableFolder(spark, f"{tmp_path}/one", {"segmento": "string"}).read()
    assert sorted(r.segmento for r in one.collect()) == ["HAB", "HAB", "HDA"]


def test_export_sheets(spark, tmp_path):
    df = spark.createDataFrame([("F 1", "0203", "=1+1"), ("F 1", "TTL", "ok\x01")], "file string, sheet string, v string")
    names = export.export_sheets(df, str(tmp_path / "x")).orderBy("posicao").collect()
    assert [r.sheet for r in names] == ["TTL", "0203"]
    back = spark.read.option("header", True).schema("v string, file string, sheet string").csv(str(tmp_path / "x"))
    assert {(r.sheet, r.v) for r in back.collect()} == {("0203", "'=1+1"), ("TTL", "ok")}
    with pytest.raises(GateError, match="file_path"):
        export.export_sheets(df.withColumn("file", F.lit("../x")), str(tmp_path / "y"))


def test_sheet_names(spark):
    long = "x" * 40
    df = spark.createDataFrame([("f", n) for n in ("a/b:c", long, long + "y", "", "ttl")], "file string, sheet string")
    got = {r.sheet: (r.nome, r.posicao) for r in export.safe_sheet_names(df).collect()}
    assert got["a/b:c"][0] == "a-b-c" and got[""][0] == "Planilha" and got["ttl"][1] == 1
    assert {got[long][0], got[long + "y"][0]} == {"x" * 31, "x" * 28 + "_2"}
    assert export.row_limit(62) == 80645 and export.row_limit(2) == 1_000_000


def test_tabular_source_keeps_zeros(spark, tmp_path, now):
    write(tmp_path, "CAD0203_2026.10.csv", ["Empresa,Material,Item Principal Cadeia", "0200,M1,SIM", "0200,,x"])
    raw = readers.with_file_lineage(readers.read_tabular_strings(spark, str(tmp_path)))
    master = materials.load_master(raw, "L1", now, "me").collect()
    assert len(master) == 1 and (master[0].empresa, master[0].reference_date) == ("0200", date(2026, 10, 1))


def test_promote_header(spark):
    from partflow.operators.project import promote_header

    df = spark.createDataFrame([("Centro", "Material", "Comp."), ("0203", "A", "B"), ("Centro", "Material", "Comp.")],
                               "_c0 string, _c1 string, _c2 string")
    got = promote_header(df, ["Centro", "Material", "Comp."])
    assert got.columns == ["centro", "material", "comp"] and got.count() == 1


def test_history_source_and_catalog(spark, tmp_path):
    spark.range(2).write.parquet(str(tmp_path / "a" / "b"))
    spark.range(3).write.parquet(str(tmp_path / "a" / "c" / "d"))
    assert readers.read_history(spark, str(tmp_path / "a")).count() == 5
    spark.range(1).createOrReplaceTempView("refined_demand_x")
    assert readers.list_tables(spark, "refined_demand_") == ["refined_demand_x"]
    assert readers.date_spine(spark, date(2026, 1, 1), date(2026, 1, 31)).count() == 31


def test_annotate(spark):
    spark.sql("CREATE TABLE notes (id BIGINT) USING parquet")
    assert annotate(spark, "notes", "it's a table", {"id": "key"}, {"business_owner": "planning"}, version="1")
    assert not annotate(spark, "notes", "again", version="1")
    assert spark.catalog.getTable("notes").description == "it's a table"
    spark.sql("DROP TABLE notes")


def test_stream_files_grow_with_the_lines(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "LINES_A_FILE", 100)
    items = [(n // 2, n % 2, n % 9, float(n % 50), 0.01 * (n % 9)) for n in range(1000)]
    folder = str(tmp_path / "tables")
    spark.createDataFrame(items, "l_orderkey long, l_linenumber int, l_partkey long, l_quantity double, l_tax double").write.parquet(
        f"{folder}/lineitem.parquet")
    spark.createDataFrame([(n, n % 20, date(2001, 1, 1 + n % 28)) for n in range(500)],
                          "o_orderkey long, o_custkey long, o_orderdate date").write.parquet(f"{folder}/orders.parquet")
    seen = []

    def read(session, path, files_per_batch):
        seen.append((files_per_batch, len(session.read.text(path).inputFiles())))
        return readers.read_lines_stream(session, path, files_per_batch=files_per_batch)

    monkeypatch.setattr(files, "read_lines_stream", read)
    inputs = Inputs(spark, folder)
    found = files.stream_lines(inputs)
    assert seen[0] == (4, 12)
    lines = {row.value for row in inputs.view("fx_lines").collect()}
    assert sorted((row.value, row.com_arquivo) for row in found.collect()) == sorted((line, True) for line in lines if line.strip())

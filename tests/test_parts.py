"""Tables in parts, keyed state in them, and closings from monthly sums."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from partflow import runs
from partflow.config import CARS
from partflow.plans import enrich
from partflow.plans.monthly import MonthSums, month_parts
from partflow.registry.demand import Closing
from partflow.registry.fixtures import Inputs
from partflow.sinks import parts
from partflow.sinks.parts import KeyedParts, PartFolder


def test_part_folder(spark, tmp_path):
    table = PartFolder(spark, str(tmp_path / "t"), "p", "k int, p string")

    def rows(*pairs):
        return spark.createDataFrame(list(pairs), "k int, p string")

    def found(**how):
        return sorted((r.p or "", r.k) for r in table.read(**how).collect())

    assert found() == [] and table.versions() == []
    table.write(rows((1, "01"), (2, "02"), (3, None)), ["01", "02", None], 0)
    assert found() == [("", 3), ("01", 1), ("02", 2)] and found(parts=["01", None]) == [("", 3), ("01", 1)]
    table.write(rows((5, "02")), ["02", "01"], 1)  # 01 is empty from now on
    assert found() == [("", 3), ("02", 5)] and found(before=1) == [("", 3), ("01", 1), ("02", 2)]
    assert sorted(table.changed(0)) == ["01", "02"] and table.changed(1) == []
    table.write(rows((7, "09")), ["09"], 2, whole=True)
    assert found() == [("09", 7)] and {*table.changed(1)} == {"01", "02", "09", None}
    table.write(rows((5, "02")), ["02", "01"], 1)  # a replay from before
    assert found() == [("09", 7)]
    # A write that did not end is not seen.
    rows((8, "09")).write.partitionBy("p").parquet(str(tmp_path / "t" / "rows" / "_version=3"))
    (tmp_path / "t" / "rows" / "_version=3" / "_SUCCESS").unlink()
    assert found() == [("09", 7)]


SCHEMA = "k bigint, j string, day date, v int, p int"


def brute(state, batch):
    return {**state, **batch}


@pytest.mark.parametrize("by_key", [True, False])
@pytest.mark.parametrize("most", [200_000, 30])
def test_keyed_parts(spark, tmp_path, monkeypatch, by_key, most):
    monkeypatch.setattr(parts, "BROADCAST_KEYS", most)
    deal = F.expr("k div 10") if by_key else F.col("v") % 7
    store = KeyedParts(spark, str(tmp_path / "s"), ["k", "j"], "p", deal.cast("int"), SCHEMA, by_key, ["v"])

    def rows(pairs):
        return spark.createDataFrame([(k, j, date(2026, 1, 1), v) for (k, j), v in pairs], "k bigint, j string, day date, v int")

    def found():
        return {(r.k, r.j): r.v for r in store.read().collect()}

    first = {(k, "a"): k for k in range(100)} | {(5, None): 1, (None, "x"): 2}
    store.refresh(rows(first.items()), 0)
    assert found() == first and store.read().count() == len(first)
    second = {(k, "a"): k + 3 for k in range(40, 45)} | {(5, None): 9, (777, "b"): 0}
    for _ in range(2):
        store.upsert(rows([*second.items(), ((777, "b"), -1)]), 1)
        assert found() == first | second
    if by_key:
        assert {*store.parts.changed(0)} == {4, 0, 77}
    third = {(k, "a"): -k for k in range(0, 100, 3)} | {(None, "x"): 4}
    store.upsert(rows(third.items()), 2)
    store.upsert(rows([*second.items(), ((777, "b"), -1)]), 1)
    assert found() == first | second | third and store.read().count() == len(first | second | third)


def test_old_rows_stay_in_place(spark, tmp_path):
    store = KeyedParts(spark, str(tmp_path / "s"), ["k"], "p", F.expr("k div 100"), "k bigint, v bigint, p bigint")
    store.refresh(spark.range(1000).select(F.col("id").alias("k"), F.lit(1).cast("long").alias("v")), 0)
    batch = spark.createDataFrame([(5, 2), (205, 2)], "k bigint, v bigint")
    placed = store._placed(batch)
    plan = store.kept(placed, store._meetings(placed, 1), 1)._jdf.queryExecution().executedPlan().toString()
    old = plan[:plan.index("BroadcastExchange")]
    assert "Exchange" not in old and "LeftAnti" in old
    assert "PartitionFilters" in plan and "IN (0,2)" in plan.replace(" ", "").replace("IN(", "IN (")
    store.upsert(batch, 1)
    assert sorted(store.parts.newest().items()) == [(n, 1 if n in (0, 2) else 0) for n in range(10)]


def test_large_batch_reads_old_rows_once(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(parts, "BROADCAST_KEYS", 30)
    store = KeyedParts(spark, str(tmp_path / "s"), ["k"], "p", F.expr("k div 100"), "k bigint, v bigint, p bigint")
    store.refresh(spark.range(1000).select(F.col("id").alias("k"), F.lit(1).cast("long").alias("v")), 0)
    batch = spark.range(0, 1200, 2).select(F.col("id").alias("k"), F.lit(2).cast("long").alias("v"))
    placed = store._placed(batch)
    plan = store.kept(placed, store._meetings(placed, 1), 1)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    # Rows that were shuffled by their keys are gathered by part, so a part has few files.
    assert plan.index("REBALANCE_PARTITIONS_BY_COL") < plan.index("LeftAnti")
    store.upsert(batch, 1)
    assert {(r.k, r.v) for r in store.read().collect()} == {(k, 1) for k in range(1, 1000, 2)} | {(k, 2) for k in range(0, 1200, 2)}


def test_many_parts_are_packed(spark, tmp_path, monkeypatch):
    """Files grow in number with the rows, not with the parts; parts are replaced and read as folders of their own are."""
    monkeypatch.setattr(parts, "PART_FOLDERS", 20)
    monkeypatch.setattr(parts, "BROADCAST_KEYS", 30)
    store = KeyedParts(spark, str(tmp_path / "s"), ["k"], "p", F.expr("k div 10"), "k bigint, v bigint, p bigint")

    def rows(pairs):
        return spark.createDataFrame(list(pairs.items()), "k bigint, v bigint")

    def found(of=None):
        return {r.k: r.v for r in store.read(of).collect()}

    def files(version):
        return [*(tmp_path / "s" / "rows" / f"_version={version}").rglob("part-*.parquet")]

    first = {k: 1 for k in range(1000)} | {None: 1}
    for _ in range(2):
        store.refresh(rows(first), 0)
        assert found() == first and len(store.parts.newest()) == 101 and len(files(0)) < 20
    assert not (tmp_path / "s" / "aside" / "_version=0").exists()
    few = {5: 2, 205: 2, None: 2, 5000: 2}
    for _ in range(2):
        store.upsert(rows(few), 1)  # four folders beside the packed parts
        assert found() == first | few and len(files(1)) >= 4
    assert found([0, 3, None]) == {k: v for k, v in (first | few).items() if k is None or k // 10 in (0, 3)}
    many = {k: 3 for k in range(0, 1200, 4)}
    for _ in range(2):
        store.upsert(rows(many), 2)
        assert found() == first | few | many and len(files(2)) < 40
    assert found([119, 500, None]) == {1192: 3, 1196: 3, 5000: 2, None: 2}
    assert {*store.parts.changed(1)} == {*range(120)}
    store.refresh(rows(few), 3)
    assert found() == few and not (tmp_path / "s" / "aside" / "_version=3").exists()


@pytest.fixture(scope="module")
def closing(spark, data):
    return Closing(Inputs(spark, data))


def same_rows(found, wanted):
    return found.columns == wanted.columns and found.exceptAll(wanted).isEmpty() and wanted.exceptAll(found).isEmpty()


def test_closing_of_sums(spark, closing, tmp_path):
    """The cubes after a late batch equal those over all sales, and the closing is written from them."""
    keyed = month_parts(spark, f"{tmp_path}/sales")
    sums = MonthSums(spark, f"{tmp_path}/sums", keyed)
    late = F.col("data") >= "2001-07-01"
    keyed.refresh(closing.sales.where(~late), 0)
    assert len(sums.update()) == 78 and sums.anchor() == date(2001, 6, 1)
    keyed.upsert(closing.sales.where(late), 1)
    names = runs.run_closing_of_sums(spark, f"{tmp_path}/b", sums, closing.chain, closing.area, orgs=(CARS,))
    assert len(names) == 11 and sums.anchor() == date(2001, 8, 1) and sums.update() == []
    assert {*sums.sums.changed(0)} == {date(2001, 7, 1), date(2001, 8, 1)}
    anchor = closing.anchor
    assert same_rows(enrich.cube_of_sums(sums.read(anchor, 60), closing.chain, closing.area),
                     enrich.demand_cube(keyed.read(), closing.chain, closing.area, anchor))
    assert same_rows(enrich.customer_cube_of_sums(sums.read(anchor, 12), closing.chain, "ZPUG"),
                     enrich.customer_cube(keyed.read(), closing.chain, anchor, 12, "ZPUG"))


def test_sums_read_changed_months_only(spark, closing, tmp_path):
    keyed = month_parts(spark, f"{tmp_path}/sales")
    keyed.refresh(closing.sales.where("data >= '2001-05-01'"), 0)
    month = keyed.read([date(2001, 7, 1)])
    plan = enrich.partial_sums(month)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "2001-07-01" in plan[plan.index("PartitionFilters"):]
    files = {row[0] for row in month.select(F.input_file_name()).distinct().collect()}
    assert files and all("mes=2001-07-01" in file for file in files)

"""Domain rules on small hand-made inputs."""

import re
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import Row, Window
from pyspark.sql import functions as F

from partflow.config import DEMAND_VIEWS, HISTORY_TRACKED, HORIZON, MOTORCYCLES
from partflow.operators import aggregate, joins, project, quality, running, state
from partflow.operators.quality import GateError, enforce, gate_chronology, gate_loaded
from partflow.plans import calendar, demand, enrich, forecast, history, inventory, supersession
from partflow.registry.demand import Closing
from partflow.registry.fixtures import Inputs
from partflow.sinks import export


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# --- running totals and ABC ------------------------------------------------------------


def test_abc_by_hand(spark):
    counts = {"a": 50, "b": 25, "c": 10, "d": 10, "e": 5, "f": 0}
    line_rows = spark.createDataFrame(
        [(MOTORCYCLES, "TTL", k, date(2026, 10, 1), v) for k, v in counts.items() if v]
        + [(MOTORCYCLES, "TTL", "f", date(2025, 1, 1), 9)],
        "org_vendas string, sheet string, item string, mes date, valor int")
    got = {r["Item Principal Cadeia"]: r for r in demand.abc_curve(line_rows, date(2026, 10, 15)).collect()}
    assert [got[k]["classe_linha"] for k in "abcdef"] == list("AABCDE")
    assert [got[k]["rank"] for k in "abcdef"] == [1, 2, 3, 4, 5, 6]
    assert [round(got[k]["perc_acc"], 4) for k in "abcdef"] == [0.5, 0.75, 0.85, 0.95, 1.0, 1.0]
    assert got["a"]["file"] == "HDA 2026 Out Demanda Linha" and got["a"]["2026/10"] == 50


def test_abc_all_zero(spark):
    line_rows = spark.createDataFrame([(MOTORCYCLES, "TTL", "x", date(2020, 1, 1), 3)],
                                      "org_vendas string, sheet string, item string, mes date, valor int")
    row = demand.abc_curve(line_rows, date(2026, 10, 1)).first()
    assert (row["part_perc"], row["perc_acc"], row["classe_linha"]) == (0.0, 0.0, "E")


def test_ranked_totals_equal_plain_window_under_skew(spark):
    """One group with most rows and one value for a third of them."""
    df = spark.range(3000).select(
        F.when(F.col("id") % 10 < 8, "hot").otherwise(F.concat(F.lit("g"), (F.col("id") % 7).cast("string"))).alias("g"),
        F.when(F.col("id") % 3 == 0, 1).otherwise((F.col("id") * 37 % 101).cast("int")).alias("v"),
        F.concat(F.lit("i"), F.lpad(F.col("id").cast("string"), 6, "0")).alias("item"))
    order = Window.partitionBy("g").orderBy(F.col("v").desc(), "item")
    plain = df.select(
        "g", "v", "item", F.row_number().over(order).alias("rank"),
        F.sum("v").over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("running"),
        F.sum("v").over(Window.partitionBy("g")).alias("total"))
    assert rows(running.ranked_totals(df, ["g"], "v", ["item"], chunks=13)) == rows(plain)


# --- joins -----------------------------------------------------------------------------


@pytest.mark.parametrize("threshold", ["10m", "-1"])
def test_lookup_equals_plain_join(spark, threshold):
    fact = spark.range(2000).select(
        "id", F.when(F.col("id") % 3 == 0, None).when(F.col("id") % 3 == 1, "hot")
        .otherwise((F.col("id") % 50).cast("string")).alias("k"))
    dim = spark.createDataFrame([("hot", "H"), ("5", "five"), ("8", "eight"), ("8", "again"), ("none", "x")], "code string, v string")
    plain = rows(fact.join(dim, fact.k == dim.code, "left").select("id", "k", "v"))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        joined = joins.lookup_join(fact, dim, {"k": "code"})
        assert joined.columns == ["id", "k", "v"] and rows(joined) == plain
        inner = joins.lookup_join(fact, dim, {"k": "code"}, how="inner")
        assert inner.count() == sum(1 for r in plain if r[2] is not None)
        for how in ("full", "right"):
            with pytest.raises(ValueError):
                joins.lookup_join(fact, dim, {"k": "code"}, how=how)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_lookup_of_many_rows_from_a_small_file_is_not_broadcast(spark, tmp_path):
    spark.createDataFrame([(1,)], "c int").write.parquet(f"{tmp_path}/area")
    fact = spark.createDataFrame([(1, "a"), (7, "b"), (None, "c")], "k int, f string")
    for rows, broadcast in ((joins.LOOKUP_ROWS, True), (joins.LOOKUP_ROWS + 1, False)):
        dim = spark.read.parquet(f"{tmp_path}/area").select(
            F.explode(F.sequence(F.col("c"), F.lit(rows))).alias("code")).withColumn("v", F.col("code") * 2)
        joined = joins.lookup_join(fact, dim, {"k": "code"})
        assert ("BroadcastHashJoin" in joined._jdf.queryExecution().executedPlan().toString()) == broadcast
        assert sorted(map(tuple, joined.select("f", "v").collect())) == [("a", 2), ("b", 14), ("c", None)]


def test_null_keys_and_scopes(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3), ("b", 4), ("b", 5)], "k string, v int")
    assert rows(aggregate.fan_out_rows(df, ["k"])) == rows(df.where("k is null or k = 'b'"))
    assert rows(aggregate.keep_one_to_one(df, ["k"])) == [("a", 3)]
    batch = spark.createDataFrame([(None, 9), ("b", 8)], "k string, v int")
    assert rows(state.replace_scopes(df, batch, ["k"])) == rows(spark.createDataFrame([("a", 3), (None, 9), ("b", 8)], df.schema))
    ranked = running.ranked_totals(df, ["k"], "v", ["v"])
    assert sorted(map(str, ranked.select("k", "v", "rank", "running", "total").collect())) == sorted(map(str, [
        Row(k=None, v=2, rank=1, running=2, total=3), Row(k=None, v=1, rank=2, running=3, total=3),
        Row(k="a", v=3, rank=1, running=3, total=3), Row(k="b", v=5, rank=1, running=5, total=9),
        Row(k="b", v=4, rank=2, running=9, total=9)]))


def test_past_anchor_leaves_later_sales_out(spark, data):
    closing = Closing(Inputs(spark, data))
    past = date(closing.anchor.year - 1, 3, 1)
    limit = closing.sales.where(F.col("data") < F.lit(date(past.year, 4, 1)))
    whole, cut = (enrich.demand_cube(sales, closing.chain, closing.area, past, 12) for sales in (closing.sales, limit))
    assert rows(whole) == rows(cut) and whole.schema == cut.schema
    assert rows(demand.distribution(whole, "0200", past)) == rows(demand.distribution(
        closing.cube(), "0200", past)) and whole.count() > 0


def test_all_violations_are_told(spark):
    bad = spark.range(300).select(*quality.violation("r", F.lpad(F.col("id").cast("string"), 3, "0"), "x"))
    with pytest.raises(GateError) as caught:
        quality.enforce(bad, bad.where("false"))
    assert caught.value.counts == {"r": 300} and [v[1] for v in caught.value.violations] == [f"{n:03}" for n in range(100)]
    assert spark.read.parquet(caught.value.path).count() == 300


def test_sheet_names_never_repeat(spark):
    raw = ["B:", "B*", "B-_2", "B?", "ttl", None, "", "'"] + [f"{'x' * 40}{n}" for n in range(120)]
    names = export.safe_sheet_names(spark.createDataFrame([("f", name) for name in raw], "file string, sheet string")).collect()
    assert len({r.nome for r in names}) == len(raw) and all(0 < len(r.nome) <= 31 for r in names)
    assert sorted(r.posicao for r in names) == list(range(1, len(raw) + 1)) and min(names, key=lambda r: r.posicao).sheet == "ttl"


def test_sheet_names_of_one_stem_only_meet(spark):
    """Named by stem as one after the other in a workbook; a name and what is numbered from it have one stem."""
    raw = ["a", "a:", "a*", "a-", "a-_2", "a-_2_2", "a-_", "b\n", "b_2\n", "b_2\n_2"] + [f"{stem}{n}" for stem in (
        "x" * 40, "x" * 27 + "_", "x" * 18 + "_", "y:", "y_") for n in range(110)]
    got = export.safe_sheet_names(spark.createDataFrame([("f", n) for n in raw], "file string, sheet string")).collect()
    taken = set()
    for row in sorted(got, key=lambda r: r.posicao):
        name = free = re.sub(r"[\[\]:*?/\\]", "-", row.sheet).strip("'")[:31]
        number = 2
        while free in taken:
            free, number = f"{name[:min(28, 30 - len(str(number)))]}_{number}", number + 1
        taken.add(free)
        assert row.nome == free
    assert [r.sheet for r in sorted(got, key=lambda r: r.posicao)] == sorted(raw)
    names = ["x" * 31, "x" * 28 + "_2", "x" * 27 + "_100", "ab", "ab_7", "x" * 21 + "_999999999"]
    stems = spark.createDataFrame([(n,) for n in names], "n string").select(export.name_stem(F.col("n")))
    assert [r[0] for r in stems.collect()] == ["x" * 20] * 3 + ["ab"] * 2 + ["x" * 20]


def test_latest_refined_cycle(spark):
    """The cycle whose rows are all dropped does not count, nor does a missing one."""
    horizons = {h: 0.0 for h in HORIZON}
    rows = [{"forecast_cycle": date(2001, m, 1) if m else None, "forecast_type": kind, "_load_id": "L", "segment": "0200",
             "main_material": "M", **{c: "x" for c in ("department", "market", "forecast_classification")}, **horizons}
            for m, kind in ((0, "Judgment"), (3, "Judgment"), (4, "Judgment"), (5, "Enrich"), (6, None))]
    text = ("department", "forecast_type", "segment", "market", "main_material", "forecast_classification", "_load_id")
    schema = ", ".join(["forecast_cycle date", *[f"{c} string" for c in text], *[f"`{h}` double" for h in HORIZON]])
    raw = spark.createDataFrame([tuple(r[c] for c in ("forecast_cycle", *text, *HORIZON)) for r in rows], schema)
    chain = spark.createDataFrame([], "empresa string, material string, item_principal_cadeia string")
    refined = forecast.forecast_refined(raw, chain)
    assert forecast.latest_refined_cycle(refined, raw) == date(2001, 4, 1) == aggregate.max_of(refined, "forecast_cycle")
    assert forecast.latest_refined_cycle(refined.limit(0), raw) is None


def test_wide_stages_stay_below_the_compiled_size(spark, data):
    """Queries hold the limit of HotSpot's compiler also in a session that others built."""
    spark.conf.unset("spark.sql.codegen.hugeMethodLimit")
    Inputs(spark, data)
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"


def test_one_to_one_and_fan_out_split_the_rows(spark):
    df = spark.createDataFrame([("a", 1), ("b", 1), ("b", 2), ("c", None)], "k string, v int")
    one = aggregate.keep_one_to_one(df, ["k"])
    assert rows(one) == [("a", 1), ("c", None)]
    assert one.unionByName(aggregate.fan_out_rows(df, ["k"])).count() == df.count()


# --- demand ----------------------------------------------------------------------------


def test_sheets_add_up_to_total(spark, data):
    closing = Closing(Inputs(spark, data))
    view = DEMAND_VIEWS["fechada"]
    measures = demand.demand_measures(closing.cube(), [view])
    total = measures.where("sheet = 'TTL'").groupBy("org_vendas").agg(F.sum("fechada").alias("t"))
    per_sheet = measures.where("sheet <> 'TTL'").groupBy("org_vendas").agg(F.sum("fechada").alias("s"))
    cube = closing.cube().where("centro_original IS NULL").groupBy("org_vendas").agg(F.sum("quantidade").alias("u"))
    for row in total.join(per_sheet, "org_vendas").join(cube, "org_vendas").collect():
        assert row.t == row.s + row.u


def test_views_move_the_cube_once(spark):
    """Every grain and sheet is summed from one shuffle of the cube's own measures; grains that agree share a row."""
    views = [DEMAND_VIEWS[key] for key in ("fechada", "fechada_sem_zesp", "aberta", "linha", "me")]
    month, found = date(2001, 8, 1), {}
    data = [("0200", "01", "ZNOR", "0203", "A", "A"), ("0200", "02", "ZESP", "0203", "A", "B"), ("0200", "01", None, None, "B", "B"),
            ("0200", "01", "ZNOR", "0999", "B", "A"), ("0500", "02", "ZNOR", "0503", None, None), ("0500", "01", "ZNOR", "0203", "A", "C"),
            ("0500", "01", "ZNOR", "0505", None, "A"), ("0999", "01", "ZNOR", "0203", "A", "A"), (None, "01", "ZNOR", "0203", "A", "A")]
    cube = spark.createDataFrame(
        [(*row, month, None if n == 2 else Decimal(1 << n), 2, 3) for n, row in enumerate(data)],
        "org_vendas string, canal_dist string, tipo_ov string, centro_original string, item_principal_cadeia string, material string, "
        "mes date, quantidade decimal(28,3), linhas long, registros long")
    for r in cube.where("org_vendas IN ('0200', '0500')").collect():
        centers = ("0203", "0209", "0232") if r.org_vendas == "0200" else ("0503", "0505")
        for grain in ("item_principal_cadeia", "material"):
            for sheet in ["TTL", *[c for c in centers if c == r.centro_original]]:
                sums = found.setdefault((r.org_vendas, grain, sheet, r[grain], month), [None] * 10)
                hits = (True, r.tipo_ov is not None and r.tipo_ov != "ZESP", True, True, r.canal_dist == "02")
                for n, (view, hit) in enumerate(zip(views, hits, strict=True)):
                    for at, value in ((2 * n, r.quantidade if view.measure == "sum" else r.linhas), (2 * n + 1, r.registros)):
                        if hit and value is not None:
                            sums[at] = (sums[at] or 0) + value
    measures = demand.demand_measures(cube, views)
    assert {tuple(r[:5]): list(r[5:]) for r in measures.collect()} == found and measures.count() == len(found)
    plan = measures._jdf.queryExecution().executedPlan().toString()
    plan = plan[plan.index("Initial Plan"):] if "Initial Plan" in plan else plan
    assert plan.count("Exchange hashpartitioning") == 1 and "partial_sum" not in plan[plan.index("Exchange hashpartitioning"):]


def test_lookup_fan_out_multiplies_sums(spark):
    """Summing before the join gives what summing after it gives, repeated lookup keys included.

    The area is broadcast under the first limit and joined on sums under the second.
    """
    sales = spark.createDataFrame(
        [("0200", "01", "ZNOR", "04", 7, "M", date(2001, 8, 1), Decimal("2.000")),
         ("0200", "01", "ZNOR", "04", 7, "M", date(2001, 8, 3), Decimal("3.000"))],
        "org_vendas string, canal_dist string, tipo_ov string, setor_ativ string, emissor_da_ordem bigint, "
        "material string, data date, quantidade decimal(18,3)")
    area = spark.createDataFrame([("7", "0200", "01", "04", "0203")] * 2,
                                 "cliente string, orgv string, cdst string, sa string, cen string")
    chain = spark.createDataFrame([("0200", "M", "P")], "empresa string, material string, item_principal_cadeia string")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for threshold in (limit, "-1"):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
            row = enrich.demand_cube(sales, chain, area, date(2001, 8, 1)).first()
            assert (row.item_principal_cadeia, row.quantidade, row.registros) == ("P", Decimal("10.000"), 4)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_distribution_by_hand(spark):
    cube = spark.createDataFrame(
        [("0200", "01", "0203", "A", date(2026, 10, 1), Decimal(30)), ("0200", "02", "0209", "A", date(2026, 9, 1), Decimal(10)),
         ("0200", "01", "0203", "B", date(2025, 12, 1), Decimal(5)), ("0200", "01", None, "C", date(2026, 10, 1), Decimal(4))],
        "org_vendas string, canal_dist string, centro_original string, item_principal_cadeia string, mes date, "
        "quantidade decimal(18,3)")
    got = {r["Item Principal Cadeia"]: r for r in demand.distribution(
        cube, "0200", date(2026, 10, 1), ["0203", "0209", "0232"], unassigned="drop").collect()}
    assert [got["A"][c] for c in ("%_0203", "%_0209", "%_0232", "%_MI", "%_ME")] == [75.0, 25.0, 0.0, 75.0, 25.0]
    assert (got["B"]["DMD_0203"], got["B"]["DMD_MI"], got["B"]["%_MI"]) == (0, 5, 100.0)
    bucket = demand.distribution(cube, "0200", date(2026, 10, 1))
    assert {"DMD_null", "%_null"} <= set(bucket.columns)


def test_closed_month_window(spark):
    df = spark.createDataFrame([(date(2026, 10, 15),), (date(2025, 11, 1),), (date(2025, 10, 31),)], "d date")
    assert rows(project.closed_month_window(df, "d", 12)) == [(date(2025, 11, 1),), (date(2026, 10, 15),)]
    assert project.closed_month_window(df, "d", 13, date(2026, 10, 1), half_open=True).count() == 3


# --- history ---------------------------------------------------------------------------


def snap(spark, values):
    return spark.createDataFrame(list(values.items()), "k string, row_hash string")


def test_scd2_by_hand(spark):
    m1, m2, m3 = date(2026, 1, 1), date(2026, 2, 1), date(2026, 3, 1)
    hist = state.open_versions(snap(spark, {"A": "x", "B": "y", "C": "z"}), state.scd2_start(None, m1))
    for moment, values in ((m2, {"A": "x", "B": "y2", "D": "w"}), (m3, {"A": "x", "B": "y2", "C": "z", "D": "w"})):
        start = datetime(moment.year, moment.month, 1)
        hist = state.scd2_apply(hist, state.open_versions(snap(spark, values), start), ["k"], moment)
    first, d2, d3 = datetime(1900, 1, 1), datetime(2026, 2, 1), datetime(2026, 3, 1)
    assert rows(hist.select("k", "row_hash", "start_date", "end_date", "is_current")) == sorted([
        ("A", "x", first, None, True), ("B", "y", first, d2, False), ("B", "y2", d2, None, True),
        ("C", "z", first, d2, False), ("C", "z", d3, None, True), ("D", "w", d2, None, True)], key=repr)
    with pytest.raises(GateError):
        enforce(gate_chronology(hist, m3))
    with pytest.raises(GateError):
        enforce(gate_chronology(hist, m2), gate_loaded(hist, m2))
    enforce(gate_chronology(hist, date(2026, 4, 1)), gate_loaded(hist, date(2026, 4, 1)))


def test_scd2_closed_audit(spark):
    hist = state.open_versions(snap(spark, {"A": "x", "B": "y"}), state.HISTORY_START).withColumn("_load_id", F.lit("1"))
    stage = state.open_versions(snap(spark, {"A": "x2"}), datetime(2026, 2, 1)).withColumn("_load_id", F.lit("2"))
    new = state.scd2_apply(hist, stage, ["k"], date(2026, 2, 1), closed_audit={"_load_id": F.lit("2")})
    assert rows(new.select("k", "row_hash", "is_current", "_load_id")) == [
        ("A", "x", False, "2"), ("A", "x2", True, "2"), ("B", "y", False, "2")]


def master_row(**changes):
    base = {c: "v" for c in HISTORY_TRACKED if c != "lead_time"}
    base |= {"data_cadeia": "3/5/98", "cut_in_material": "00.00.0000", "cut_off_material": None, "empresa": "0200",
             "material": "M1", "centro": "0203", "tipo_de_material": "ZFER",
             "prazo_entrega_prevista_lead_time_firme": " 30 "}
    return base | changes


def test_load_history(spark):
    schema = ", ".join(f"{c} string" for c in master_row())
    one = spark.createDataFrame([master_row(), master_row(centro="0209")], schema)
    loaded = history.load_history(None, one, date(2026, 1, 1))
    row = loaded.first()
    assert loaded.count() == 1 and (row.data_cadeia, row.lead_time) == ("05.03.1998", "30")
    changed = spark.createDataFrame([master_row(cadeia="w"), master_row(material="M2", tipo_de_material="ZXXX")], schema)
    assert history.load_history(loaded, changed, date(2026, 2, 1)).count() == 2
    with pytest.raises(GateError, match="divergence"):
        history.load_history(None, spark.createDataFrame(
            [master_row(), master_row(centro="0209", cadeia="w")], schema), date(2026, 1, 1))


# --- inventory -------------------------------------------------------------------------


def stock_row(**changes):
    from partflow.config import INVENTORY_QUANTITIES

    return {**{c: "1" for c in INVENTORY_QUANTITIES}, "empresa": "0200", "material": "M", "centro": "0203",
            "tipo_de_material": "ZHAW", **changes}


@pytest.mark.parametrize("second, rule", [
    (stock_row(estoque_bloqueado="12,30-"), "number"), (stock_row(centro=" "), "key"),
    (stock_row(estoque_bloqueado="2"), "conflict"),
])
def test_inventory_gates(spark, second, rule):
    schema = ", ".join(f"{c} string" for c in stock_row())
    with pytest.raises(GateError, match=rule):
        inventory.inventory_snapshot(spark.createDataFrame([stock_row(), second], schema), date(2026, 1, 1))


def test_inventory_snapshot(spark):
    schema = ", ".join(f"{c} string" for c in stock_row())
    df = spark.createDataFrame([stock_row(estoque_devolucoes="9"), stock_row(estoque_devolucoes="9,00")], schema)
    row = inventory.inventory_snapshot(df, date(2026, 1, 1)).collect()
    assert len(row) == 1 and row[0].estoque_total == Decimal("5.00")
    with pytest.raises(GateError, match="empty"):
        inventory.inventory_snapshot(df.where("false"), date(2026, 1, 1))


# --- forecast --------------------------------------------------------------------------


def wide_forecast(spark, cells):
    """Rows (type, quantity at lag 0, quantity at lag 3, quantity at lag 12)."""
    schema = ("forecast_cycle date, department string, forecast_type string, segment string, market string, "
              "main_material string, forecast_classification string, _load_id string, "
              + ", ".join(f"`n+{i}` double" for i in range(36)))
    data = []
    for kind, q0, q3, q12 in cells:
        horizon = [None] * 36
        horizon[0], horizon[3], horizon[12] = q0, q3, q12
        data.append((date(2026, 1, 1), "Export - Parts", kind, "0200", "Export", "M", "Supply - Parts - X", "L1", *horizon))
    return spark.createDataFrame(data, schema)


def test_forecast_refined(spark):
    chain = spark.createDataFrame([("0200", "M", "P")], "empresa string, material string, item_principal_cadeia string")
    raw = wide_forecast(spark, [("Enrich", 0.0, 2.0, 9.0), ("Judgment", 0.0, None, 9.0), (None, 0.0, 1.0, None)])
    long = forecast.forecast_refined(raw, chain)
    got = {(r.forecast_type, r.lag): r for r in long.collect()}
    assert {k for k in got if k[0] == "Enrich"} == {("Enrich", 3)}
    assert len([k for k in got if k[0] == "Judgment"]) == 12
    assert (None, 0) not in got and (None, 3) in got
    row = got["Enrich", 3]
    assert (row.forecast_month, row.department, row.material, row.main_material, row.forecast_classification_tag) == (
        date(2026, 4, 1), "Parts", "M", "P", "Parts - X")
    assert forecast.forecast_refined(raw, chain, long).count() == 0


def test_forecast_metrics(spark):
    df = spark.createDataFrame([(80.0, 100), (5.0, 0)], "forecast_qty double, actual_qty bigint")
    a, b = forecast.forecast_metrics(df).collect()
    assert (a.error, a.abs_error, a.abs_pct_error, round(a.accuracy, 6)) == (-20.0, 20.0, 0.2, 0.8)
    assert b.abs_pct_error is None and b.accuracy is None


def test_negative_groups(spark):
    keys = "forecast_cycle date, segment string, material string, forecast_month date, forecast_qty double"
    day = date(2026, 1, 1)
    refined = spark.createDataFrame(
        [(day, "0200", "neg", day, -5.0), (day, "0200", "noise", day, -1e-9), (day, "0200", "mix", day, 10.0),
         (day, "0200", "mix", day, -3.0)], keys)
    assert [r.material for r in forecast.forecast_negatives(refined).collect()] == ["neg"]
    assert sorted(r.material for r in forecast.forecast_export(refined).collect()) == ["mix", "noise"]


def test_prev_slices(spark):
    chain = spark.createDataFrame([], "empresa string, material string, item_principal_cadeia string")
    slices = forecast.forecast_prev_slices(wide_forecast(spark, [("Enrich", 1.0, 2.0, 3.0)]), chain)
    assert len(slices) == 6 and slices["Forecast N-1 2W Exportação 2026-01"].count() == 1
    assert slices["Forecast N-1 4W 2026-01"].count() == 0


def test_wide_views_spread_with_their_rows(spark, data, monkeypatch):
    from partflow.registry import fixtures

    monkeypatch.setattr(fixtures, "SPREAD_ROWS", 5, raising=False)
    inputs = Inputs(spark, data)
    parts = -(-inputs.table("part").count() // 5)
    assert parts > 16 and "hashpartitioning(p_partkey#" in (plan := inputs.view("fx_forecast")._jdf.queryExecution().executedPlan().toString())
    assert f", {parts})" in plan


# --- supersession ----------------------------------------------------------------------


def test_supersession_by_hand(spark):
    master = spark.createDataFrame(
        [("0500", m, t, b, i) for m, t, b, i in (
            ("C1", "ZRO1", "042", "SIM"), ("F1", "ZFER", "042", "F2"), ("F2", "ZFER", "042", "SIM"),
            ("F1 C", "ZFER", "042", None), ("F3", "ZFER", "042", "SIM"), ("F4", "ZFER", "054", "SIM"),
            ("C2", "ZRO1", "042", "SIM"), ("C3", "ZRO1", "042", "SIM"))],
        "empresa string, material string, tipo_de_material string, grupo_de_compradores string, item_principal_cadeia string")
    bom = spark.createDataFrame([("0503", "F1", "C1"), ("0503", "F3", "C2"), ("0503", "F3", "C3"), ("0503", "F4", "C2")],
                                "centro string, material string, componente string")
    edges = supersession.supersession_edges(bom, master)
    assert rows(edges) == [("0500", "C1", "F2")]
    final = {r.material: tuple(r)[2:] for r in supersession.supersession_map(master, edges).collect()}
    assert final["C1"] == ("C1", "C1", "F2") and final["F1"] == ("F1", "F2", "F2") and final["F1 C"] == ("F1", "F2", "F2")
    more = edges.unionByName(spark.createDataFrame([("0500", "C1", "F0")], edges.schema))
    final = {r.material: r.item_principal_cadeia_material_final
             for r in supersession.supersession_map(master, more).collect()}
    assert final["C1"] == "F0"
    assert rows(supersession.supersession_fanout(master, more).select("material", "item_principal_cadeia_material_final")) == [
        ("C1", "F0"), ("C1", "F2")]


def test_fanout_of_a_hot_item(spark, monkeypatch):
    """The materials of an item with many produced items are dealt to tasks; rows that repeat and NULL keys stay."""
    monkeypatch.setattr(supersession, "HOT_ITEM", 3)
    master = spark.createDataFrame(
        [("0500", f"M{n}", "ZRO1", "042", "HOT") for n in range(40)] + [("0500", "M0", "ZRO1", "042", "HOT")]
        + [("0500", "A1", "ZRO1", "042", "A"), ("0500", "B1", "ZRO1", "042", "B"), (None, "N", "ZRO1", "042", "A")] * 2
        + [("0500", "C1", "ZRO1", "042", "C")],
        "empresa string, material string, tipo_de_material string, grupo_de_compradores string, item_principal_cadeia string")
    edges = spark.createDataFrame(
        [("0500", "HOT", f"P{n}") for n in range(9)] + [("0500", "A", "P1"), ("0500", "A", "P2"), ("0500", "C", "P3"), (None, "A", "P4")],
        "empresa string, item_principal_cadeia_componente string, item_principal_cadeia_material_produzido string")
    want = aggregate.fan_out_rows(supersession.supersession_rows(master, edges), supersession.KEYS)
    found = supersession.supersession_fanout(master, edges)
    assert rows(found) == rows(want) and found.where("material = 'M1'").count() == 9


# --- calendar --------------------------------------------------------------------------


def test_calendar(spark):
    cal = calendar.calendar_dim(spark).cache()
    summary = calendar.calendar_summary(cal).first()
    assert (summary.total_registros, summary.total_feriados, summary.total_fins_semana, summary.total_dias_uteis) == (
        7670, 252, 2192, 5274)
    years = {r.ano: r for r in calendar.calendar_year_summary(cal).collect()}
    assert years[2026].dias_uteis == 250
    one = cal.where("data = DATE '2024-12-30'").first()
    assert (one.semana_ano, one.dia_semana, one.nome_dia_semana_pt, one.nome_mes_abrev_en) == (1, 1, "Segunda", "Dec")
    include = spark.createDataFrame([(date(2025, 1, 1), "Local"), (date(2025, 1, 6), "Reis")], "data date, nome string")
    exclude = spark.createDataFrame([(date(2025, 4, 21),), (date(2026, 11, 15),)], "data date")
    new = {r.data: r for r in calendar.apply_holiday_overrides(cal, include, exclude).where("ano IN (2025, 2026)").collect()}
    assert new[date(2025, 1, 1)].nome_feriado == "Confraternização Universal / Local"
    assert new[date(2025, 1, 6)].feriado and not new[date(2025, 1, 6)].dia_util
    assert not new[date(2025, 4, 21)].feriado and new[date(2025, 4, 21)].dia_util
    assert not new[date(2026, 11, 15)].dia_util  # a Sunday stays a weekend day
    assert calendar.apply_holiday_overrides(cal).count() == 7670

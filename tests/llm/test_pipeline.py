"""The stages on planted rows, each judged on its own input, and the registered queries."""

import corpus_pipeline
import pytest
from llm_texts import prose
from partflow.llm import queries
from partflow.session import scratch_path

OPERATORS = {"op1_mixing", "op2_decontamination", "op3_simhash", "op4_private", "op5_lines", "op6_tokens", "op7_chat",
             "op8_passages", "op9_toxicity", "op10_neighbours", "op11_vector_codes", "op12_hard_negatives", "op13_token_files"}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Tables with toxic documents, repeated lines, copies and benchmark passages."""
    path = tmp_path_factory.mktemp("tables")
    passage, copy, line = prose(60, 30), prose(61, 120), prose(62, 15)
    docs, labels = [], []
    for n in range(400):
        toxic = n % 4 == 0
        docs.append((n, prose(1000 + n, 30) + (" badword" if toxic else ""), "en", f"s{n % 3}", 1))
        labels.append((n, 1, int(toxic)))
    docs += [(1000 + n, copy, "en", "s0", 1) for n in range(50)]
    docs += [(2000 + n, prose(3000 + n, 30) + "\n" + line, "en", "s1", 1) for n in range(10)]
    docs += [(4000 + n, prose(5000 + n, 30) + " " + passage, "en", "s2", 1) for n in range(10)]
    docs += [(6000, None, None, None, None), (6001, "", "en", None, 0), (None, prose(6100, 20), None, "s1", 5)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        path = scratch_path(spark, "stage")
        stage(spark, docs, folder).write.parquet(path)
        docs = spark.read.parquet(path)
        seen[name] = docs.collect()
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
    ids = {name: {row.doc_id for row in rows} for name, rows in seen.items()}
    planted = {n for n in range(0, 400, 4)}
    assert len(ids["toxicity"] & planted) <= 5
    assert ids["toxicity"] >= {n for n in range(400) if n % 4} | {6000, 6001, None}
    assert len(seen["line_dedup"]) == len(seen["toxicity"])
    kept = {row.doc_id: row for row in seen["line_dedup"]}
    assert "\n" in kept[2000].text and not any("\n" in kept[2000 + n].text for n in range(1, 10))
    assert kept[1000].text and kept[1000].n_chars == len(kept[1000].text) and not kept[1001].text
    assert ids["simhash_dedup"] >= {1000, 2000, 2005, 4003} and 1001 in ids["simhash_dedup"]
    assert not ids["simhash_dedup"] & {n for n in range(1002, 1050)}
    assert ids["decontamination"] == ids["simhash_dedup"] - set(range(4000, 4010))
    assert {row.doc_id for row in seen["mixing"]} <= ids["decontamination"] and all(0 < row.taken <= 2 * row.size for row in seen["mixing"])


def test_run_and_empty_table(spark, folder, tmp_path):
    assert corpus_pipeline.run(spark, folder).count() > 250
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").where("false").write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_every_operator_is_registered():
    assert set(queries.queries()) == OPERATORS
    assert set(queries.oracle_sql()) <= OPERATORS

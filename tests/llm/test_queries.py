import hashlib
import os

import duckdb
import pytest

from barloom.llm import oracles, queries


def test_entry_lists_them():
    import __spark_entry__ as entry

    assert set(queries.queries()) | {"pipeline"} <= set(entry.queries())
    assert set(oracles.oracle_sql()) <= set(queries.queries())


@pytest.mark.parametrize("name", sorted(oracles.oracle_sql()))
def test_oracle(spark, sf_dir, name):
    connection = duckdb.connect()
    for table in ("documents", "benchmark", "conversations", "embeddings"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{os.path.join(sf_dir, table)}.parquet'")
    got = queries.queries()[name](spark, sf_dir).toPandas()
    want = connection.execute(oracles.oracle_sql()[name]).df()
    columns = sorted(got.columns)
    rows = [sorted(map(str, f[columns].itertuples(index=False, name=None))) for f in (got, want)]
    assert sorted(want.columns) == columns and hashlib.md5("".join(rows[0]).encode()).digest() == hashlib.md5("".join(rows[1]).encode()).digest()


@pytest.mark.parametrize("name", ["op1_quality_classifier", "op6_language_id"])
def test_held_out_accuracy(spark, sf_dir, name):
    sf_dir = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.01")  # the smallest tables have too few labels to learn from
    found = queries.queries()[name](spark, sf_dir).where("held_out")
    if name.startswith("op1"):
        truth, same = spark.read.parquet(f"{sf_dir}/labels.parquet"), "predicted = quality"
    else:
        truth, same = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang"), "lang_pred = lang"
    joined = found.join(truth, "doc_id")
    assert joined.where(same).count() >= 0.9 * joined.count() > 0


def test_op4_returns_near_matches(spark, tmp_path, documents):
    words = [f"leak{k}" for k in range(12)]
    put_in = " ".join(words[:6] + ["new"] + words[6:])
    documents((1, " ".join(words)), (2, put_in), (3, None)).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, " ".join(words))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    found = {r["doc_id"]: r for r in queries.queries()["op4_near_decontamination"](spark, str(tmp_path)).collect()}
    assert [(found[k]["n_hit"], found[k]["n_near"] > 0, found[k]["near_items"]) for k in (1, 2, 3)] == [(12, True, ["1"]), (0, True, ["1"]), (0, False, [])]
    contract = queries.queries()["op4_decontamination"](spark, str(tmp_path))
    assert {r["doc_id"]: r["n_hit"] for r in contract.collect()} == {1: 12, 2: 0, 3: 0}

import corpus_pipeline as pipeline
import pytest


@pytest.fixture
def small(spark, tmp_path):
    """Labels and benchmark of a small corpus."""
    labels = [(k, 1) for k in range(8)] + [(k, 0) for k in range(100, 108)]
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, " ".join(f"leak{k}" for k in range(12)))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def test_stages_keep_columns_and_survive_odd_rows(spark, small, documents):
    text = lambda k: " ".join(f"plain{(k * 7 + j * j) % 50}word" for j in range(40))
    rows = [(k, text(k)) for k in range(8)] + [(100 + k, "BAD!! " * 30) for k in range(8)]
    rows += [(20, text(3)), (None, text(3)), (None, None), (30, ""), (30, ""), (31, " ".join(f"leak{k}" for k in range(12)))]
    docs = documents(*rows)
    for _, stage in pipeline.STAGES[:-1]:
        out = stage(spark, docs, small)
        assert out.columns == docs.columns and stage(spark, docs.where("false"), small).count() == 0


def test_near_duplicates_keep_one_of_each_group(spark, small, documents):
    docs = documents((5, "a b c d e"), (3, "a b c d e"), (3, "a b c d e"), (None, "a b c d e"), (None, "q r s t u"), (None, "q r s t u"))
    kept = pipeline.near_duplicates_stage(spark, docs, small).collect()
    assert sorted((r["doc_id"] or -1, r["text"]) for r in kept) == [(-1, "q r s t u"), (3, "a b c d e")]


def test_leaks_go_and_clean_documents_stay(spark, small, documents):
    leak = "x " + " ".join(f"LEAK{k}" for k in range(1, 12)) + " y"
    docs = documents((1, leak), (2, "leak1 leak2"), (None, leak), (3, None))
    assert sorted((r["doc_id"]) for r in pipeline.decontamination_stage(spark, docs, small).collect()) == [2, 3]


def test_near_leaks_go(spark, small, documents):
    words = [f"leak{k}" for k in range(12)]
    put_in, swapped, apart = words[:6] + ["new"] + words[6:], [*words[:4], words[5], words[4], *words[6:]], words[:6] + ["a", "b", "c"] + words[6:]
    docs = documents((1, " ".join(put_in)), (2, " ".join(swapped)), (3, " ".join(apart)), (4, "clean"))
    assert sorted(r["doc_id"] for r in pipeline.decontamination_stage(spark, docs, small).collect()) == [3, 4]


def test_mix_repeats_documents(spark, small, documents):
    docs = documents((1, "a b", "en", "s"), (2, "a b", "en", "t"), (2, "a b", "en", "t"), (3, None, "en", None))
    counts = pipeline.mixing_stage(spark, docs, small).groupBy("doc_id").count()
    assert all(r["count"] <= 4 for r in counts.collect())


def test_run(spark, sf_dir):
    found = pipeline.run(spark, sf_dir).collect()
    assert found and all(r["n_tokens"] >= 1 for r in found)

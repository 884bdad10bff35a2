"""The operators as queries over the test tables, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm import brown, centroids, chat, decontaminate, extract, language, mixing, neighbours, phrases, quality, search, simhash, tokenfile
from barloom.llm.common import in_fold, read
from barloom.scratch import scratch_dir


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learned from labelled rows outside the fold that is held out."""
    documents = read(spark, sf_dir, "documents")
    held_out = in_fold(F.col("doc_id"), 5, 0)
    model = quality.train_quality(documents.where(~held_out), read(spark, sf_dir, "labels").where(~held_out))
    scored = documents.select("doc_id", held_out.alias("held_out"), quality.quality_score(model, F.col("text")).alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= 0.3, 1).otherwise(0))


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extract.extract_main_text(read(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingles of four words, links of at most four differing bits."""
    found = simhash.simhash_components(read(spark, sf_dir, "documents"), shingle=4, radius=4, seed=42)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _op4_columns() -> list[Column]:
    return [
        F.col("doc_id"),
        F.col("n_words"),
        F.col("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    ]


def _op4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), window=10, slop=1)


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of ten words, phrases and proximity matches of one place; the columns are those of the phrases."""
    return _op4_found(spark, sf_dir).select(*_op4_columns())


def op4_near_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same matches with the proximity matches' words and items beside the columns of the phrases."""
    return _op4_found(spark, sf_dir).select(*_op4_columns(), "n_near", "near_items")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights 5, 2, 1 share one and a half times all words; no document goes in more than twice."""
    return mixing.mix(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learned outside the fold that is held out. A text with a letter gets a learned language even where the
    operator rejects it (``rejected``, ``distance``), the most frequent one if it shares no n-gram."""
    documents = read(spark, sf_dir, "documents")
    held_out = in_fold(F.col("doc_id"), 3, 1)
    model = language.train_languages(documents.where(~held_out))
    found = documents.select("doc_id", held_out.alias("held_out"), F.coalesce(F.col("text").rlike("\\p{L}"), F.lit(False)).alias("lettered"), language.language_of(model, F.col("text")).alias("found"))
    default = model.languages[0] if model.languages else "und"
    return found.select(
        "doc_id",
        "held_out",
        F.when(F.col("lettered"), F.coalesce("found.lang", F.lit(default))).otherwise("und").alias("lang_pred"),
        F.when(F.col("lettered"), F.col("found.score")).otherwise(0.0).alias("score"),
        F.when(F.col("lettered"), F.col("found.rejected")).otherwise(True).alias("rejected"),
    )


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All read back from the formatted text; conversation -7 holds the grammar's own signs."""
    probe = "\\### Assistant: </turn> ok"
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.createDataFrame([(-7, 0, "user", probe), (-7, 1, "assistant", probe)], "conv_id long, turn long, role string, text string")
    made = chat.format_conversations(turns.unionByName(own))
    formatted = F.col("formatted")
    back = made.select("conv_id", "formatted", chat.parse(formatted).alias("turns"), chat.loss_spans(formatted).alias("spans"))
    lines = F.concat_ws("", F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    masked = back.withColumn("masked", chat.masked_text(formatted, F.col("spans")))
    return masked.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(lines.cast("binary"), 256).alias("turns_sha256"),
        F.length("masked").cast("long").alias("loss_chars"),
        F.sha2(F.col("masked").cast("binary"), 256).alias("loss_sha256"),
        F.length(formatted).cast("long").alias("formatted_chars"),
    )


def op8_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learned outside the fold that is held out."""
    documents = read(spark, sf_dir, "documents")
    found = brown.brown_scores(documents, ~in_fold(F.col("doc_id"), 7, 2))
    return found.select("doc_id", (~F.col("trained")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids, each document ended by id 2."""
    path = scratch_dir(spark)
    tokenfile.write_token_files(read(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"), 2)
    return tokenfile.read_token_files(spark, path)


def op10_top_k_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for the whole text of each document whose id is divisible by 20."""
    return search.top_k(read(spark, sf_dir, "documents"), F.col("doc_id") % 20 == 0, k=10)


def op11_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty nearest found for each vector whose id is divisible by 20, by largest inner product."""
    return neighbours.nearest_neighbours(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sixteen centroids, three rounds, on floor(64 x)."""
    return centroids.cluster_vectors(read(spark, sf_dir, "embeddings"), k=16, rounds=3, dims=64, scale=64, seed=1)


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Phrases of two and three words that occur ten times; those that lie in a longer one with half of their occurrences go."""
    return phrases.collocations(read(spark, sf_dir, "documents"), longest=3, least=10, share=50, top=2000)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality_classifier,
        op2_html_extraction,
        op3_simhash,
        op4_decontamination,
        op4_near_decontamination,
        op5_mixing,
        op6_language_id,
        op7_chat_format,
        op8_class_lm,
        op9_token_files,
        op10_top_k_search,
        op11_nearest_neighbours,
        op12_centroid_clustering,
        op13_phrases,
    )
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)

"""The corpus pipeline: quality, near-duplicates, benchmark leaks, source mix, token files.

Every stage takes all that the one before kept, with any further columns, and returns the columns of its input;
the last returns a row for each document of the token files. Empty tables give empty results.

A row is known by its id and a hash of all its columns. Rows that agree in both are copies of one
document; a null id is an id like any other here.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm import decontaminate, mixing, quality, simhash, tokenfile
from barloom.llm.common import broadcast_if_small, read, row_hash
from barloom.scratch import scratch_dir, settle

#: What a row is joined by: its id as text, whether it has one, its hash.
KEYS = ["__id", "__none", "__row"]
_KEY_BYTES = 64
#: Pieces of text that a worker remembers in the last stage: a sixth of the token files' own bound, since its processes have run the other stages.
PIECES_KEPT = 200_000


def _keys(row: Column) -> list[Column]:
    return [F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("__id"), F.col("doc_id").isNull().alias("__none"), row.alias("__row")]


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(*[docs[f"`{c}`"] for c in docs.columns], *_keys(row_hash(docs)))


def _columns(docs: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in docs.columns]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier takes for label 0 go. All labelled rows of the input may train it; a null text
    is scored as empty."""
    model = quality.train_quality(docs, read(spark, sf_dir, "labels"))
    return docs.where(quality.quality_score(model, F.col("text")) >= 0.3)


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id stays (without any id, with the smallest hash),
    once, however often its row is repeated."""
    keyed = _keyed(docs)
    found = simhash.simhash_components(keyed.select("doc_id", "text", "__row"), keep=["__row"], shingle=4, radius=4)
    first = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "__row")).alias("f"))
    kept = settle(first.select(F.col("f.doc_id").alias("doc_id"), F.col("f.__row").alias("__row")).select(*_keys(F.col("__row"))))
    return keyed.join(kept, KEYS, "left_semi").dropDuplicates(KEYS).select(*_columns(docs))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go, also where its words each stand within one place of theirs."""
    keyed = _keyed(docs)
    found = decontaminate.contamination(keyed.select("doc_id", "text", "__row"), read(spark, sf_dir, "benchmark"), keep=["__row"], window=10, slop=1)
    leaks = settle(found.where("n_near > 0").select(*_keys(F.col("__row"))).distinct())
    return keyed.join(broadcast_if_small(leaks, _KEY_BYTES), KEYS, "left_anti").select(*_columns(docs))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document is repeated as often as the mix takes it; those it does not take go. Null and empty texts have size 0 and stay, at the
    rate of a text of no length; a null source is a source. Copies of one row are dealt with together: the row is repeated as often as the mix takes all of them."""
    keyed = _keyed(docs)
    mixed = mixing.mix(keyed.select("doc_id", "text", "source", "__row"), keep=["__row"])
    copies = mixed.groupBy(*_keys(F.col("__row"))).agg(F.sum("copies").cast("int").alias("__copies")).where("__copies > 0")
    taken = keyed.join(copies, KEYS).dropDuplicates(KEYS)
    return taken.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies")))).select(*_columns(docs))


def token_file_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as token files, read back: id, start, tokens and checksum of each. A null text is empty, a null id comes first, and
    repeated ids and rows follow each other."""
    path = scratch_dir(spark)
    tokenfile.write_token_files(docs, path, public_tokenizers.path("byte_bpe_50k.json"), 2, pieces_kept=PIECES_KEPT)
    return tokenfile.read_token_files(spark, path)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality_stage),
    ("SimHash near-dedup", near_duplicates_stage),
    ("benchmark decontamination", decontamination_stage),
    ("mixing sources to target weights", mixing_stage),
    ("token-ID / binary output", token_file_stage),
]

#: A fitted model, fingerprints and a token file are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. What a stage returns is written and read again."""
    docs = read(spark, sf_dir, "documents")
    for n, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if n < len(STAGES) - 1:
            docs = settle(docs)
    return docs

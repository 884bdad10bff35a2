"""Benchmark decontamination: a positional inverted index, in DataFrame operations only.

The index holds a posting (row, position, term) for every occurrence of a benchmark term in the training
texts, written once to scratch; the empty term's posting stands at the end of each text and so gives its
length. Windows of benchmark items are looked up from their rarest term: its postings, less its place in
the item, are the candidate alignments of an item with a text. The postings of the item's other terms
are intersected with the alignments' expected positions, exactly for phrases and within ``slop``
places for proximity matches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.common import LOWER, UPPER, broadcast_if_small
from barloom.scratch import settle

#: What a benchmark word and a candidate's row take in a broadcast, at most about.
_TERM_BYTES, _ROW_BYTES = 64, 24


def index_words(text: Column) -> Column:
    """Runs of digits, letters and all beyond ASCII, with A-Z in lower case; none for null."""
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.filter(F.split(lowered, "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"), lambda w: w != "")


def item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``item`` (a number for each row of ``items``), ``item_id`` as text, ``n`` words, ``p``, ``term``."""
    rows = settle(items.select(F.col(f"`{id_col}`").cast("string").alias("item_id"), index_words(F.col(f"`{text_col}`")).alias("words")))
    numbered = rows.select(F.monotonically_increasing_id().alias("item"), "item_id", "words")
    return settle(numbered.select("item", "item_id", F.size("words").alias("n"), F.posexplode("words").alias("p", "term")))


def positional_index(documents: DataFrame, text_col: str, keep: list[str], terms: DataFrame) -> DataFrame:
    """Postings (``row``, ``pos``, ``term``) of the column ``term`` of ``terms``, with the columns ``keep`` of the
    document. Every row of ``documents`` has one posting of the empty term, at the position after its last word."""
    vocabulary = terms.select("term").distinct()
    vocabulary = broadcast_if_small(vocabulary.unionByName(documents.sparkSession.sql("SELECT '' AS term")), _TERM_BYTES)
    rows = documents.select(
        F.monotonically_increasing_id().alias("row"),
        *[F.col(f"`{c}`") for c in keep],
        F.array_append(index_words(F.col(f"`{text_col}`")), F.lit("")).alias("words"),
    )
    tokens = rows.select("row", *[F.col(f"`{c}`") for c in keep], F.posexplode("words").alias("pos", "term"))
    return settle(tokens.join(vocabulary, "term"))


def rarest_terms(terms: DataFrame, index: DataFrame, window: int) -> DataFrame:
    """``item``, ``p1``, ``term1``, ``p2``, ``term2``: the rarest and the second rarest term of each window whose
    terms all occur, with their places in the item. A window of one word has no second."""
    frequency = index.where("term <> ''").groupBy("term").agg(F.count("*").alias("cf"))
    known = terms.join(frequency, "term", "left").select("item", "n", F.struct(F.coalesce("cf", F.lit(0)).alias("cf"), "p", "term").alias("t"))
    whole = known.groupBy("item", "n").agg(F.array_sort(F.collect_list("t"), lambda x, y: x["p"] - y["p"]).alias("ts"))
    starts = whole.select("item", "ts", F.least("n", F.lit(window)).alias("length"), F.explode(F.sequence(F.lit(1), F.greatest(F.col("n") - window, F.lit(0)) + 1)).alias("s"))
    ranked = starts.select("item", F.array_sort(F.slice("ts", F.col("s"), F.col("length"))).alias("r")).where("r[0].cf > 0")
    first, second = F.get("r", F.lit(0)), F.get("r", F.lit(1))
    return ranked.select("item", first["p"].alias("p1"), first["term"].alias("term1"), second["p"].alias("p2"), second["term"].alias("term2")).distinct()


def alignments(index: DataFrame, terms: DataFrame, window: int, slop: int) -> DataFrame:
    """``row``, ``item``, ``delta``: where an item may stand in a text. The postings of a window's rarest term, less its
    place, intersected with those of its second rarest, less its own, each within ``slop`` places."""
    shifts = F.explode(F.sequence(F.lit(-slop), F.lit(slop)))
    rarest = settle(rarest_terms(terms, index, window))
    first = broadcast_if_small(rarest.select("item", "p1", F.col("term1").alias("term")).distinct(), _TERM_BYTES)
    found = index.join(first, "term").select("row", "item", "p1", F.col("pos"), shifts.alias("shift"))
    found = found.select("row", "item", "p1", (F.col("pos") - F.col("p1") + F.col("shift")).alias("delta")).distinct()
    pairs = broadcast_if_small(rarest.select("item", "p1", "p2", F.col("term2").alias("term")).distinct(), _TERM_BYTES)
    wanted = found.join(pairs, ["item", "p1"])
    postings = index.join(broadcast_if_small(pairs.select("term").where("term is not null").distinct(), _TERM_BYTES), "term").select("row", "pos", "term")
    shifted = wanted.where("term is not null").withColumn("shift", shifts)
    both = shifted.withColumn("pos", F.col("delta") + F.col("p2") + F.col("shift")).join(postings, ["row", "pos", "term"])
    alone = wanted.where("term is null")
    return both.select("row", "item", "delta").unionByName(alone.select("row", "item", "delta")).distinct()


def window_matches(index: DataFrame, terms: DataFrame, window: int = 10, slop: int = 0) -> DataFrame:
    """The item words that are matched: ``row``, ``item``, ``item_id``, ``pos``, ``phrase`` and ``near``.

    ``phrase``: the word lies in a window of consecutive item words that stand one after the other in the text.
    ``near``: it lies in a window whose words each stand within ``slop`` places of where they belong;
    ``pos`` is that place, for each alignment of the item with the text. Rows that are neither are left out.
    """
    candidates = settle(alignments(index, terms, window, slop))
    in_rows = candidates.select("row").distinct()
    if in_rows.count() * _ROW_BYTES <= 8 << 20:
        index = index.join(F.broadcast(in_rows), "row", "left_semi")
    shifts = F.explode(F.sequence(F.lit(-slop), F.lit(slop)))
    spans = terms.select("item", "item_id", "n", "p", "term")
    spans = broadcast_if_small(spans, _TERM_BYTES)
    expected = candidates.join(spans, "item").withColumn("shift", shifts).withColumn("pos", F.col("delta") + F.col("p") + F.col("shift")).where("pos >= 0")
    met = expected.join(index.select("row", "pos", "term"), ["row", "pos", "term"])
    places = met.groupBy("row", "item", "delta", "p").agg(F.min(F.abs("shift")).alias("off"), F.first("item_id").alias("item_id"), F.least(F.first("n"), F.lit(window)).alias("length"))
    along = Window.partitionBy("row", "item", "delta").orderBy("p")
    ahead, behind = along.rangeBetween(0, window - 1), along.rangeBetween(1 - window, 0)
    starts = places.select(
        "*",
        (F.count(F.when(F.col("off") == 0, 1)).over(ahead) == F.col("length")).alias("phrase_start"),
        (F.count("*").over(ahead) == F.col("length")).alias("near_start"),
    )
    covered = starts.select(
        "row",
        "item",
        "item_id",
        (F.col("delta") + F.col("p")).alias("pos"),
        F.max("phrase_start").over(behind).alias("phrase"),
        F.max("near_start").over(behind).alias("near"),
    )
    return covered.where("phrase or near")


def contamination(
    documents: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", keep: list[str] | None = None, window: int = 10, slop: int = 1
) -> DataFrame:
    """One row for each row of ``documents``: its id, the columns ``keep``, ``n_words``, ``n_hit`` (words inside an
    occurrence of a window), ``items`` (sorted ids, as text, of the items with an occurring window), ``n_near`` (words inside a
    proximity match, which each phrase is too) and ``near_items`` (the ids of the items with such a match).

    A window is ``window`` consecutive words of an item; an item of fewer words is one window, an item
    without words none. Null texts have no words. Repeated rows stay rows of their own; items that share
    an id count once, and one without id is matched but not listed.
    """
    terms = item_terms(items, item_id_col, item_text_col)
    kept = [id_col, *(keep or [])]
    index = positional_index(documents, text_col, kept, terms)
    matches = settle(window_matches(index, terms, window, slop))
    hits = matches.groupBy("row").agg(
        F.count_distinct(F.when(F.col("phrase"), F.col("pos"))).alias("n_hit"),
        F.array_sort(F.collect_set(F.when(F.col("phrase"), F.col("item_id")))).alias("items"),
        F.count_distinct("pos").alias("n_near"),
        F.array_sort(F.collect_set("item_id")).alias("near_items"),
    )
    none = F.array().cast("array<string>")
    ends = index.where("term = ''").select("row", *[F.col(f"`{c}`") for c in kept], F.col("pos").cast("long").alias("n_words"))
    return ends.join(hits, "row", "left").select(
        *[F.col(f"`{c}`") for c in kept],
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", none).alias("items"),
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.coalesce("near_items", none).alias("near_items"),
    )

"""Phrase collocations by dynamic itemset counting.

The documents are dealt to shards, which are scanned in a cycle. Words are counted in the first cycle. A longer phrase
is counted from the first shard after both of its subphrases (without its last word, without its first) have been
counted ``least`` times so far, and is done when it has seen every shard once; so lengths are counted side by side, and
the scans end after as many cycles as the longest phrase has words.

Which phrases have reached ``least`` is known to the tasks as bitmaps of their hashes, of a fixed size at any size
of the input. Bits are never unset, and a phrase that shares another's bit is counted for nothing, so every phrase that
reaches ``least`` is counted once in each shard. Phrases are counted as the 64-bit hashes of their words; the words'
table shows that no two words share a hash, or else the count begins again with another seed, so counts are exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.common import LOWER, UPPER, broadcast_if_small, row_hash
from barloom.llm.tokenfile import ROWS, give_back
from barloom.scratch import arrow_rows, settle

#: Bytes of text whose tokens a task holds at once, and rows of counts that it adds up before it returns them.
CHUNK_BYTES, HELD_ROWS = 4 << 20, 1 << 19
#: Bits of a map of what has reached the least count (4 MB).
FILTER_BITS = 1 << 25
#: A byte that UTF-8 doesn't have stands for the end of a piece.
_END = b"\xff"
_TABLE = bytes.maketrans(UPPER.encode() + b".,;:!?\x0a\x0b\x0c\x0d\x09", LOWER.encode() + _END * 10 + b" ")
#: Constants of the public XXH64 hash, by which Spark's ``xxhash64`` goes too.
_P1, _P2, _P3, _P4, _P5 = (np.uint64(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


def chained(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Spark's ``xxhash64`` of some longs and one more, from that of the longs before (42 for none); all as unsigned numbers."""
    turn = lambda x, n: (x << np.uint64(n)) | (x >> np.uint64(64 - n))
    x = (before + _P5 + np.uint64(8)) ^ (turn(word * _P2, 31) * _P1)
    x = turn(x, 27) * _P1 + _P4
    x = (x ^ (x >> np.uint64(33))) * _P2
    x = (x ^ (x >> np.uint64(29))) * _P3
    return x ^ (x >> np.uint64(32))


def steps_outside(maps: list[np.ndarray | None], h: np.ndarray) -> np.ndarray:
    """In how many of the maps (from the earliest on, each within the next; None is empty) a hash has no bit."""
    out = np.zeros(len(h), np.int64)
    for bits in maps:
        if bits is None:
            out += 1
        else:
            at = h & np.uint64(len(bits) * 64 - 1)
            out += (bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 0
    return out


def _schema(longest: int) -> pa.Schema:
    words = [(f"w{n}", pa.int64()) for n in range(1, longest + 1)]
    return pa.schema([("a", pa.int32()), ("lang", pa.string()), ("word", pa.binary()), *words, ("c", pa.int64())])


def _table(schema: pa.Schema, rows: int, **columns: pa.Array) -> pa.Table:
    """A table of the given columns, the others null."""
    return pa.Table.from_arrays([columns[f.name] if f.name in columns else pa.nulls(rows, f.type) for f in schema], schema=schema)


def count_tokens(coded: pa.DictionaryArray, lang: str, skip: int, maps: list[list[np.ndarray | None]], step: int, with_words: bool, seed: int = 0) -> tuple[list[pa.Table], list[pa.Table]]:
    """Counts of a run of coded tokens in a scan's ``step``: of the words if asked for, and of the active phrases of two words and more.

    ``maps`` has for each length the bitmaps of the phrases one word shorter, before each of the steps of one cycle and before
    the one ahead of it: a phrase in all of them is done, one in none is not active. ``a`` is the step whose map was the first to hold
    both its subphrases. The first ``skip`` tokens are of the run before: only what ends after them counts.
    """
    schema = _schema(len(maps) + 1)
    spelled, ids = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
    start = lang.encode() + b"\x00"
    hashes = np.array([xxhash.xxh64_intdigest(start + w, seed) for w in spelled.to_pylist()], np.uint64)
    end = pc.index(spelled, pa.scalar(_END, pa.binary())).as_py()
    words, phrases = [], []
    if with_words:
        c = np.bincount(ids[skip:], minlength=len(spelled))
        if end >= 0:
            c[end] = 0
        seen = np.flatnonzero(c)
        n = len(seen)
        words.append(_table(schema, n, a=pa.array(np.zeros(n, np.int32)), lang=pa.array([lang] * n, pa.string()), word=spelled.take(pa.array(seen)), w1=pa.array(hashes[seen].view(np.int64)), c=pa.array(c[seen])))
    # Of the phrase that starts at a token: its number among the different ones here, and of those the words and the hash.
    number, parts, h = ids, [np.arange(len(spelled))], chained(np.uint64(42), hashes)
    inside = ids != end
    for n, of_step in enumerate(maps, 2):
        if of_step[-1] is None or len(number) < 2:
            break
        outside = steps_outside(of_step, h)
        at_token = np.where(inside, outside[number], len(of_step))
        late = np.maximum(at_token[:-1], at_token[1:])
        at = np.flatnonzero(late < len(of_step))
        if not len(at):
            break
        last = ids[at + n - 1]
        different = pa.array(number[at] * len(spelled) + last).dictionary_encode()
        key, back = different.dictionary.to_numpy(), different.indices.to_numpy()
        before, word = key // len(spelled), key % len(spelled)
        parts, h = [*[p[before] for p in parts], word], chained(h[before], hashes[word])
        steps = np.zeros(len(key), np.int64)
        steps[back] = late[at]
        c = np.bincount(back[at + n - 1 >= skip], minlength=len(key))
        seen = np.flatnonzero((steps > 0) & (c > 0))
        if len(seen):
            of_words = {f"w{k}": pa.array(hashes[p[seen]].view(np.int64)) for k, p in enumerate(parts, 1)}
            phrases.append(_table(schema, len(seen), a=pa.array((step - len(of_step) + steps[seen]).astype(np.int32)), c=pa.array(c[seen]), **of_words))
        inside = late < len(of_step)
        number = np.zeros(len(late), np.int64)
        number[at] = back
    return words, phrases


def coded_runs(text: bytes, longest: int, size: int = CHUNK_BYTES) -> Iterator[tuple[pa.DictionaryArray, int]]:
    """The tokens of a text in runs of about ``size`` bytes, coded, each with how many of them are of the run before."""
    lowered, start, carry = text.translate(_TABLE), 0, []
    while start < len(lowered):
        cut = lowered.find(b" ", start + size) if len(lowered) - start > size else -1
        stop = len(lowered) if cut < 0 else cut
        run = b" ".join([*carry, lowered[start:stop].replace(_END, b" \xff ")]).strip(b" ")
        skip, start = len(carry), stop + (cut >= 0)
        if run:
            whole = pa.Array.from_buffers(pa.large_string(), 1, [None, pa.py_buffer(np.array([0, len(run)])), pa.py_buffer(run)])
            tokens = pc.ascii_split_whitespace(whole).values.view(pa.large_binary()).cast(pa.binary())
            carry = tokens[max(0, len(tokens) - longest + 1) :].to_pylist()
            yield tokens.dictionary_encode(), skip


def token_runs(text: bytes, longest: int, size: int = CHUNK_BYTES) -> Iterator[tuple[list[bytes], int]]:
    """The same as lists of tokens."""
    for coded, skip in coded_runs(text, longest, size):
        yield coded.cast(pa.binary()).to_pylist(), skip


def _added(tables: list[pa.Table], keys: list[str]) -> pa.Table:
    """Rows with equal keys as one, their counts added up."""
    whole = pa.concat_tables(tables)
    schema = whole.schema
    added = whole.group_by(keys).aggregate([("c", "sum")])
    named = {**{k: added[k].combine_chunks() for k in keys}, "c": added["c_sum"].combine_chunks()}
    return _table(schema, len(added), **named)


def _count_shard(shard: DataFrame, maps: list[list[Broadcast | None]], step: int, with_words: bool, seed: int, chunk: int, held_rows: int) -> DataFrame:
    """What each task counts in a shard: words with ``lang``, ``word`` and their hash ``w1``, phrases with the hashes of their words."""
    longest = len(maps) + 1
    schema = _schema(longest)
    keys = (["a", "lang", "word", "w1"], ["a", *[f"w{n}" for n in range(1, longest + 1)]])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = [[m.value if m is not None else None for m in of_step] for of_step in maps]
        held: tuple[list[pa.Table], list[pa.Table]] = ([], [])
        chunks = [0, 0]

        def added(most: int) -> Iterator[pa.RecordBatch]:
            for k, (tables, by) in enumerate(zip(held, keys, strict=True)):
                chunks[k] += 1
                if sum(map(len, tables)) > most:
                    # What one chunk counts is added up as it is.
                    whole = _added(tables, by) if chunks[k] > 1 else pa.concat_tables(tables)
                    tables.clear()
                    if len(whole) < most // 2:
                        tables.append(whole)
                    else:
                        chunks[k] = 0
                        yield from whole.to_batches(max_chunksize=1 << 16)
                    del whole
                    pa.default_memory_pool().release_unused()

        def count(waiting: dict[str, list[bytes]]) -> None:
            for lang, texts in waiting.items():
                # Texts are joined by the end of a piece, so no phrase goes from one to the next.
                for coded, skip in coded_runs(_END.join(texts), longest, chunk):
                    for tables, more in zip(held, count_tokens(coded, lang, skip, bits, step, with_words, seed), strict=True):
                        tables += more

        waiting: dict[str, list[bytes]] = {}
        size = 0
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
                waiting.setdefault(lang, []).append(text.as_py())
                size += len(waiting[lang][-1]) + 1
                if size > chunk:
                    count(waiting)
                    waiting, size = {}, 0
                    yield from added(held_rows)
        count(waiting)
        waiting.clear()
        yield from added(0)
        # A worker process runs many tasks, and other ones after these.
        give_back(True)

    kinds = {pa.int32(): "int", pa.int64(): "long", pa.string(): "string", pa.binary(): "binary"}
    return shard.mapInArrow(work, ", ".join(f"{f.name} {kinds[f.type]}" for f in schema))


def _bitmap(reached: DataFrame, words: list[str], before: Broadcast | None) -> Broadcast | None:
    """The map ``before`` with the bits of the phrases ``reached``; FILTER_BITS / 64 rows meet the driver at most."""
    at = F.xxhash64(*words)
    bit = F.expr(f"shiftleft(1L, cast(xxhash64({', '.join(words)}) & 63 as int))")
    rows = reached.select(F.shiftright(at.bitwiseAND(F.lit(FILTER_BITS - 1)), 6).alias("slot"), bit.alias("bit")).groupBy("slot").agg(F.bit_or("bit").alias("mask")).toArrow()
    if not len(rows):
        return before
    bits = np.zeros(FILTER_BITS // 64, np.uint64) if before is None else before.value.copy()
    bits[rows["slot"].to_numpy()] |= rows["mask"].to_numpy().view(np.uint64)
    return reached.sparkSession.sparkContext.broadcast(bits)


def phrase_counts(
    documents: DataFrame, text_col: str = "text", lang_col: str = "lang", longest: int = 3, least: int = 10, shards: int = 2, seed: int = 0, chunk: int = CHUNK_BYTES, held_rows: int = HELD_ROWS
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Three tables of exact counts: phrases of 2 to ``longest`` words that occur ``least`` times (``w1``, ``w2``, ... as hashes of their words, null beyond
    the last, and ``c``), the words that do (``lang``, ``word``, ``w1``, ``c``), and ``n``, all words of each ``lang``.

    Words are runs of anything but space and tab, in lower-cased (A-Z) pieces between ``.,;:!?`` and line ends. Null texts have none; null
    languages are ``und``. Repeated rows count as often as they occur. An empty table has no counts.
    """
    dealt = documents.select(
        F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col(f"`{text_col}`").cast("binary"), F.lit(b"")).alias("text"),
        F.pmod(row_hash(documents), F.lit(shards)).alias("shard"),
    )
    names = [f"w{n}" for n in range(1, longest + 1)]
    length = reduce(lambda x, y: x + y, [F.col(w).isNotNull().cast("int") for w in names])
    scans: list[DataFrame] = []
    done: list[DataFrame] = []
    #: maps[n][t]: the phrases of n words that are counted ``least`` times after t steps.
    maps: dict[int, list[Broadcast | None]] = {n: [None] for n in range(1, longest)}
    words = totals = None
    for step in range(1, longest * shards + 1):
        recent = [[maps[n][t] if t >= 0 else None for t in range(step - 1 - shards, step)] for n in range(1, longest)]
        shard = dealt.where(F.col("shard") == (step - 1) % shards).drop("shard")
        with arrow_rows(documents.sparkSession, ROWS):
            scans.append(settle(_count_shard(shard, recent, step, step <= shards, seed, chunk, held_rows)))
        # What began in the last cycle; what began a whole cycle ago is complete.
        live = reduce(DataFrame.unionByName, scans[-shards:]).where(F.col("a") >= step - shards)
        complete = F.col("a") == step - shards
        if step <= shards:
            spelled = live.where("word IS NOT NULL").groupBy("lang", "word", "w1").agg(F.sum("c").alias("c"))
            if step == shards:
                spelled = settle(spelled)
                shared = spelled.groupBy("w1").agg(F.count("*").alias("n")).where("n > 1")
                if shared.limit(1).count():
                    return phrase_counts(documents, text_col, lang_col, longest, least, shards, seed + 1, chunk, held_rows)
                totals = spelled.groupBy("lang").agg(F.sum("c").alias("n"))
            words = settle(spelled.where(F.col("c") >= least))
            maps[1].append(_bitmap(words, names[:1], maps[1][-1]))
        else:
            maps[1].append(maps[1][-1])
        phrases = live.where(F.col("word").isNull()).where(F.col(names[-1]).isNull() | complete)
        # Few phrases of a task are alike, so they travel before they are added up.
        reached = settle(phrases.repartition(*names).groupBy("a", *names).agg(F.sum("c").alias("c")).where(F.col("c") >= least).withColumn("n", length))
        done.append(reached.where(complete).select(*names, "c"))
        for n in range(2, longest):
            # Phrases of n words begin in step n and are all complete after n cycles.
            maps[n].append(_bitmap(reached.where(F.col("n") == n), names[:n], maps[n][-1]) if n <= step <= n * shards else maps[n][-1])
    for bits in {id(b): b for steps in maps.values() for b in steps if b is not None}.values():
        bits.destroy()
    return reduce(DataFrame.unionByName, done), words.select("lang", F.col("word").cast("string").alias("word"), "w1", "c"), totals


def collocations(
    documents: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    longest: int = 3,
    least: int = 10,
    share: int = 50,
    top: int = 2000,
    shards: int = 2,
    chunk: int = CHUNK_BYTES,
    held_rows: int = HELD_ROWS,
) -> DataFrame:
    """The ``top`` phrases of 2 to ``longest`` words of each language: ``lang``, ``rank``, ``phrase``, ``a`` (its occurrences),
    ``l`` and ``r`` (those of its first words and of the rest, at the cut that scores least), ``n`` (all words of the language)
    and ``score``, floor(1000000 a a / (l r)).

    Phrases occur ``least`` times; those that lie in a longer one with ``share`` percent of their occurrences go. Ties go to the
    more frequent, then to the smaller phrase in byte order; of cuts with one score the first counts. Nulls, repeated rows and empty tables: see ``phrase_counts``.
    """
    phrases, words, totals = phrase_counts(documents, text_col, lang_col, longest, least, shards, 0, chunk, held_rows)
    scored = scored_phrases(phrases, words.select("w1", "c"), longest, share)
    sizes = words.agg(F.max(F.octet_length("lang") + F.octet_length("word")), F.max(F.octet_length("lang"))).first()
    spelled = broadcast_if_small(words, 48 + (sizes[0] or 0))
    for n in range(1, longest + 1):
        of_n = spelled.select(F.col("w1").alias(f"w{n}"), F.col("word").alias(f"s{n}"), *([F.col("lang")] if n == 1 else []))
        scored = scored.join(of_n, f"w{n}", "inner" if n < 3 else "left")
    scored = scored.withColumn("phrase", F.concat_ws(" ", *[f"s{n}" for n in range(1, longest + 1)]))
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase"))
    ranked = scored.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return ranked.join(broadcast_if_small(totals, 32 + (sizes[1] or 0)), "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def scored_phrases(phrases: DataFrame, words: DataFrame, longest: int, share: int) -> DataFrame:
    """Those of the ``phrases`` (``w1``, ... and ``c``) that no longer one swallows, with ``a``, ``l``, ``r`` and ``score``, from the counts ``w1``, ``c`` of words."""
    names = [f"w{n}" for n in range(1, longest + 1)]
    listed = F.filter(F.array(*names), lambda w: w.isNotNull())
    found = settle(phrases.select(*names, F.col("c").alias("a"), listed.alias("w")))
    parts = words.select(F.array("w1").alias("w"), "c").unionByName(found.select("w", F.col("a").alias("c")))
    part = broadcast_if_small(settle(parts), 24 + 8 * longest)
    cuts = found.withColumn("k", F.explode(F.sequence(F.lit(1), F.size("w") - 1)))
    cuts = cuts.withColumn("first", F.slice("w", F.lit(1), F.col("k"))).withColumn("rest", F.slice("w", F.col("k") + 1, F.size("w") - F.col("k")))
    of = lambda side, name: part.select(F.col("w").alias(side), F.col("c").alias(name))
    parted = cuts.join(of("first", "l"), "first").join(of("rest", "r"), "rest")
    # A part occurs at least as often as the phrase, so the score is a million at most; the products may pass 64 bits.
    wide = "decimal(19,0)"
    score = F.expr(f"cast((1000000 * cast(a as {wide}) * cast(a as {wide})) div (cast(l as {wide}) * cast(r as {wide})) as bigint)")
    best = parted.groupBy("w", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    inner = found.where(F.size("w") > 2).withColumn("m", F.explode(F.sequence(F.lit(2), F.size("w") - 1)))
    inner = inner.withColumn("s", F.explode(F.sequence(F.lit(1), F.size("w") - F.col("m") + 1)))
    longer = inner.select(F.slice("w", F.col("s"), F.col("m")).alias("w"), "a").groupBy("w").agg(F.max("a").alias("longer"))
    kept = best.join(longer, "w", "left").where(F.col("longer").isNull() | (100 * F.col("longer") < share * F.col("a")))
    return kept.select(*[F.get("w", F.lit(n)).alias(w) for n, w in enumerate(names)], "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), F.col("cut.score").alias("score"))

"""Token files: id arrays, each compressed on its own with a shared zstandard dictionary.

A shard is one block of bytes::

    magic "BLTK", version (u16), bytes of an id (u16), hash of the dictionary (u64), documents (u32)
    document ids (i64 each), flags (u8 each: 1 for an id), ids (u32 each), offsets of the frames (u64 each, and the end)
    frames

so that any document is read by its number: its frame lies between two offsets. Shards are rows of a Parquet
table in ascending order of the document ids; the dictionary is a table of its own beside it. Spark writes and
reads both, so they can be in any store that Spark knows.
"""

from __future__ import annotations

import ctypes
import json
import struct
import zlib
from collections.abc import Callable, Iterator
from contextlib import suppress
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from barloom.llm.common import broadcast_if_small
from barloom.scratch import arrow_rows

MAGIC, VERSION = b"BLTK", 1
HEADER = "<4sHHQI"
#: Documents and compressed bytes of a shard.
SHARD_DOCS, SHARD_BYTES = 4096, 4 << 20
#: Documents that train the dictionary, bytes of each that it looks at, bytes of the dictionary.
SAMPLE_DOCS, SAMPLE_BYTES, DICTIONARY_BYTES = 1000, 16 << 10, 64 << 10
#: Pieces of text whose ids a worker process remembers (of more it keeps half), and their longest.
MEMO, MEMO_CHARS = 1_200_000, 64
#: Words that the tokenizer gets at once as one text.
WORDS = 1 << 13
#: Characters of the texts that are encoded at once, at least; rows of a batch that are held as Python objects at once.
CHUNK_CHARS, ROWS = 4 << 20, 1024
#: Signs that a byte-level tokenizer parts from a letter or digit before them.
TAIL = ".,!?*#$%&:;|"
#: White space other than blank and line feed, beyond ASCII.
SPACES = [chr(c) for c in range(0x80, 0x3001) if chr(c).isspace()]
#: What a byte is: a blank, a line feed, a letter or digit, a sign of ``TAIL``, other white space (1, 2, 4, 8, 16), or none of these.
KINDS = bytes(1 if c == 0x20 else 2 if c == 0x0A else 16 if c < 0x80 and chr(c).isspace() else 4 if c < 0x80 and chr(c).isalnum() else 8 if chr(c) in TAIL else 0 for c in range(256))
SHARD_SCHEMA = "part int, seq int, docs long, tokens long, payload binary"


def byte_signs() -> dict[int, str]:
    """The sign that a byte-level vocabulary writes for each byte: itself where it prints, else those from 256 on."""
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [x for x in range(256) if x not in set(prints)]
    return {x: chr(x) for x in prints} | {x: chr(256 + k) for k, x in enumerate(rest)}


@lru_cache(maxsize=2)
def encoder(tokenizer_path: str, end_id: int, pieces_kept: int = MEMO) -> Callable[[list[str]], list[np.ndarray]]:
    """A function from texts to their ids, each with ``end_id`` at the end. A worker process, which runs many tasks,
    loads a tokenizer once and keeps what it has remembered.

    A byte-level tokenizer cuts a text before each single blank and around each single line feed between other
    characters, and between a letter or digit and the signs of ``TAIL``. Pieces so cut are encoded
    once and remembered; Arrow tells which are alike and puts the ids of the texts together, so of a call only the different
    pieces are looked up. Texts with any other white space go to the tokenizer whole, and so do those that hold the
    content of an added token, which the tokenizer takes for that token, and all texts if the tokenizer is of another kind.
    """
    tokenizer = Tokenizer.from_file(tokenizer_path)
    tokenizer.no_truncation()
    made = json.loads(tokenizer.to_str())
    before = made.get("pre_tokenizer") or {}
    # The settings under which the cuts above are cuts of the tokenizer too.
    by_piece = before.get("type") == "ByteLevel" and before.get("use_regex") is True and before.get("add_prefix_space") is False and made.get("normalizer") is None
    added = [x["content"] for x in made.get("added_tokens") or []]
    memo: dict[str, bytes] = {}
    end = np.array([end_id], "<u4")

    def whole(texts: list[str]) -> list[bytes]:
        return [np.array(x.ids, "<u4").tobytes() for x in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    signs = byte_signs()
    # The same model behind a cut at line feeds only: words of letters, already written in its signs, in one long text.
    cutting = {"type": "Split", "pattern": {"String": signs[0x0A]}, "behavior": "Isolated", "invert": False}
    by_line = Tokenizer.from_str(json.dumps(made | {"pre_tokenizer": cutting, "added_tokens": [], "post_processor": None})) if by_piece else None
    mark = int(np.frombuffer(whole(["\n"])[0], "<u4")[0]) if by_piece else -1

    def learn(missing: list[str]) -> None:
        """Learn pieces: words of letters, after a blank or not, and others."""
        words = [x for x in missing if x.isalpha() or (x[0] == " " and x[1:].isalpha())]
        for k in range(0, len(words), WORDS):
            some = words[k : k + WORDS]
            text = "\n".join(["", *some]).encode().decode("latin-1").translate(signs)
            ids = np.array(by_line.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
            cuts = (4 * np.flatnonzero(ids == mark)).tolist()
            raw = ids.tobytes()
            memo.update(zip(some, [raw[a + 4 : b] for a, b in zip(cuts, [*cuts[1:], len(raw)], strict=True)], strict=True))
        if len(words) < len(missing):
            others = [x for x in missing if x not in memo]
            memo.update(zip(others, whole(others), strict=True))

    def kinds(data: bytes) -> np.ndarray:
        return np.frombuffer(data.translate(KINDS), np.uint8)

    def apart(raws: list[bytes]) -> np.ndarray:
        """Which texts may be cut: those without other white space, and without blanks and line feeds that stand together or at an end."""
        # A blank before and after each, so one at an end doesn't stand alone either.
        kind = kinds(b" ".join([b"", *raws, b""]))
        space = (kind & 3) > 0
        odd = kind == 16
        odd[1:] |= space[1:] & space[:-1]
        ends = np.cumsum([len(raw) + 1 for raw in raws])
        plain = np.ones(len(raws), bool)
        plain[np.searchsorted(ends, np.flatnonzero(odd))] = False
        return plain

    def encode(texts: list[str]) -> list[np.ndarray]:
        if len(memo) > pieces_kept:
            first = list(islice(memo.items(), pieces_kept // 2))
            memo.clear()
            memo.update(first)
        found = [end] * len(texts)
        some = [i for i, text in enumerate(texts) if text]
        cut: list[int] = []
        if by_piece and some:
            plain = apart([texts[i].encode() for i in some]).tolist()
            cut = [i for i, x in zip(some, plain, strict=True) if x and (texts[i].isascii() or not any(c in texts[i] for c in SPACES)) and not any(c in texts[i] for c in added)]
        if cut:
            raws = [texts[i].encode() for i in cut]
            starts = np.cumsum([0, *map(len, raws)])
            data = b"".join(raws)
            del raws
            kind = kinds(data)
            first = (kind & 3) > 0
            first[1:] |= (kind[:-1] == 2) | ((kind[1:] == 8) & (kind[:-1] == 4))
            first[starts[:-1]] = True
            bounds = np.append(np.flatnonzero(first), len(data))
            del kind, first
            coded = pa.Array.from_buffers(pa.large_string(), len(bounds) - 1, [None, pa.py_buffer(bounds), pa.py_buffer(data)]).dictionary_encode()
            pieces = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
            values = list(map(memo.get, pieces))
            gaps = [k for k, x in enumerate(values) if x is None]
            new = [pieces[k] for k in gaps]
            learn(new)
            for k, x in zip(gaps, new, strict=True):
                values[k] = memo[x]
            for x in new:
                if len(x) > MEMO_CHARS:
                    del memo[x]
            taken = pa.array(values, pa.large_binary()).take(coded.indices)
            at = np.frombuffer(taken.buffers()[1], np.int64, len(taken) + 1)[np.searchsorted(bounds, starts)] // 4
            ids = np.frombuffer(taken.buffers()[2], "<u4")
            for k, i in enumerate(cut):
                found[i] = np.append(ids[at[k] : at[k + 1]], end)
        left = set(some).difference(cut)
        odd = [i for i in some if i in left]
        for i, raw in zip(odd, whole([texts[i] for i in odd]), strict=True):
            found[i] = np.append(np.frombuffer(raw, "<u4"), end)
        return found

    return encode


def give_back(whole: bool) -> None:
    """Give back memory that the Arrow pool holds and doesn't use; ``whole``: and what the C library holds, where it can (that takes time)."""
    pa.default_memory_pool().release_unused()
    if whole:
        with suppress(OSError, AttributeError):
            ctypes.CDLL(None).malloc_trim(0)


def in_chunks(texts: list[str], size: int = CHUNK_CHARS) -> Iterator[tuple[int, int]]:
    """Bounds of stretches of ``texts`` that reach ``size`` characters."""
    first = held = 0
    for k, text in enumerate(texts):
        held += len(text)
        if held >= size:
            yield first, k + 1
            first, held = k + 1, 0
    if first < len(texts):
        yield first, len(texts)


def dictionary_hash(dictionary: bytes) -> int:
    return xxhash.xxh64_intdigest(dictionary)


def pack_shard(doc_ids: list[int | None], frames: list[bytes], tokens: list[int], width: int, dictionary: int) -> bytes:
    ends = np.cumsum([0, *map(len, frames)]).astype("<u8")
    known = np.array([x is not None for x in doc_ids], np.uint8)
    ids = np.array([x or 0 for x in doc_ids], "<i8")
    head = struct.pack(HEADER, MAGIC, VERSION, width, dictionary, len(frames))
    return b"".join((head, ids.tobytes(), known.tobytes(), np.array(tokens, "<u4").tobytes(), ends.tobytes(), *frames))


class Shard:
    """Access to the documents of a shard by their number."""

    def __init__(self, payload: bytes, dictionary: bytes) -> None:
        magic, version, self.width, made_with, self.docs = struct.unpack_from(HEADER, payload)
        if magic != MAGIC or version != VERSION:
            raise ValueError("not a token shard of this version")
        if made_with != dictionary_hash(dictionary):
            raise ValueError("the shard was compressed with another dictionary")
        at, n = struct.calcsize(HEADER), self.docs
        ids, known = np.frombuffer(payload, "<i8", n, at), np.frombuffer(payload, np.uint8, n, at + 8 * n)
        self.doc_ids = [int(i) if k else None for i, k in zip(ids, known, strict=True)]
        self.tokens = np.frombuffer(payload, "<u4", n, at + 9 * n)
        self.ends = np.frombuffer(payload, "<u8", n + 1, at + 13 * n)
        self.first = at + 13 * n + 8 * (n + 1)
        self.payload = payload
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        self.reader = zstandard.ZstdDecompressor(dict_data=shared)

    def ids(self, number: int) -> np.ndarray:
        frame = self.payload[self.first + int(self.ends[number]) : self.first + int(self.ends[number + 1])]
        return np.frombuffer(self.reader.decompress(frame), f"<u{self.width}").astype("<u4")


def train_dictionary(documents: DataFrame, id_col: str, text_col: str, tokenizer_path: str, end_id: int, width: int, pieces_kept: int = MEMO) -> bytes:
    """A dictionary from the first bytes of the id arrays of at most ``SAMPLE_DOCS`` documents, those with the smallest
    hash of their id; empty if there are too few to train one."""
    rows = documents.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    n = rows.count()
    near = rows.select("id").where(F.pmod(F.xxhash64("id"), F.lit(1 << 31)) * F.lit(float(max(n, 1))) < float(4 * SAMPLE_DOCS * (1 << 31)))
    chosen = near.distinct().orderBy(F.xxhash64("id"), "id").limit(SAMPLE_DOCS)

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_path, end_id, pieces_kept)
        for batch in batches:
            texts = [x or "" for x in batch.column("text").to_pylist()]
            arrays = [a.astype(f"<u{width}").tobytes()[:SAMPLE_BYTES] for a in encode(texts)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(arrays, pa.binary())], names=["id", "ids"])

    found = rows.join(F.broadcast(chosen), "id").select("id", "text").mapInArrow(sample, "id long, ids binary")
    samples = [bytes(r["ids"]) for r in found.orderBy(F.xxhash64("id"), "id", F.xxhash64("ids")).limit(SAMPLE_DOCS).collect()]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, level=3).as_bytes() if len(samples) >= 8 else b""
    except zstandard.ZstdError:  # too little to train on
        return b""


def write_token_files(documents: DataFrame, path: str, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", pieces_kept: int = MEMO) -> None:
    """Write the ids of all documents below ``path``, by ascending id, null first; a null text is empty. Repeated ids
    follow each other, by their texts. Ids must be integers, and ids of tokens below 2**32. ``pieces_kept`` bounds what a worker process
    remembers, at about 200 bytes each; fewer take more time and give the same files, and a worker then gives back all memory that it can."""
    spark = documents.sparkSession
    width = 2 if max(Tokenizer.from_file(tokenizer_path).get_vocab_size(), end_id + 1) <= 1 << 16 else 4
    rows = documents.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    dictionary = train_dictionary(rows, "id", "text", tokenizer_path, end_id, width, pieces_kept)
    spark.createDataFrame([(dictionary,)], "bytes binary").coalesce(1).write.parquet(f"{path}/dictionary")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_path, end_id, pieces_kept)
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        if shared:
            shared.precompute_compress(level=3)
        writer = zstandard.ZstdCompressor(level=3) if not shared else zstandard.ZstdCompressor(dict_data=shared)
        mark, kept, names = dictionary_hash(dictionary), ([], [], []), ["part", "seq", "docs", "tokens", "payload"]
        part, seq, held = 0, 0, 0

        def shard() -> pa.RecordBatch:
            payload = pack_shard(*kept, width, mark)
            columns = [pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([len(kept[0])]), pa.array([int(sum(kept[2]))]), pa.array([payload], pa.binary())]
            for x in kept:
                x.clear()
            return pa.RecordBatch.from_arrays(columns, names=names)

        for whole in batches:
            part = whole.column("part")[0].as_py() if whole.num_rows else part
            for batch in (whole.slice(k, ROWS) for k in range(0, whole.num_rows, ROWS)):
                doc_ids, texts = batch.column("id").to_pylist(), batch.column("text").to_pylist()
                for a, b in in_chunks(texts):
                    for doc_id, ids in zip(doc_ids[a:b], encode(texts[a:b]), strict=True):
                        frame = writer.compress(ids.astype(f"<u{width}").tobytes())
                        for x, y in zip(kept, (doc_id, frame, len(ids)), strict=True):
                            x.append(y)
                        held += len(frame)
                        if len(kept[0]) >= SHARD_DOCS or held >= SHARD_BYTES:
                            yield shard()
                            seq, held = seq + 1, 0
            # Else the pool of a worker process, which runs many tasks, keeps what all batches have taken at most.
            give_back(pieces_kept < MEMO)
        if kept[0]:
            yield shard()

    order = [F.col("id").asc_nulls_first(), F.xxhash64("text")]
    cut = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    # A batch is held several times on its way to a worker.
    with arrow_rows(spark, ROWS):
        cut.mapInArrow(work, SHARD_SCHEMA).write.option("compression", "none").parquet(f"{path}/shards")


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """A row for each document of token files: ``doc_id``, ``start`` (ids of all documents before it), ``n_tokens`` and
    ``ids_crc32`` (of its ids as little-endian unsigned 32-bit integers)."""
    shards = spark.read.schema(SHARD_SCHEMA).parquet(f"{path}/shards")
    dictionary = bytes(spark.read.parquet(f"{path}/dictionary").first()[0])
    # Offsets of the files' parts, then of the shards within a part: no task sees more than one part's shards.
    sizes = shards.select("part", "seq", "tokens")
    whole = sizes.groupBy("part").agg(F.sum("tokens").alias("tokens"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = whole.select("part", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", "seq", F.coalesce(F.sum("tokens").over(inside), F.lit(0)).alias("own")).join(F.broadcast(parts), "part")
    starts = broadcast_if_small(starts.select("part", "seq", (F.col("base") + F.col("own")).alias("start")), 32)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "start", "n_tokens", "ids_crc32"]
        # A worker process that has written runs on; what it remembers is of no use from here on.
        if encoder.cache_info().currsize:
            encoder.cache_clear()
            give_back(True)
        for batch in batches:
            for start, payload in zip(batch.column("start").to_pylist(), batch.column("payload"), strict=True):
                shard = Shard(payload.as_py(), dictionary)
                sizes = shard.tokens.astype(np.int64)
                sums = [zlib.crc32(shard.ids(k).tobytes()) for k in range(shard.docs)]
                ids = pa.array(shard.doc_ids, pa.int64())
                yield pa.RecordBatch.from_arrays([ids, pa.array(start + np.cumsum(sizes) - sizes), pa.array(sizes), pa.array(sums, pa.int64())], names=names)

    return shards.join(starts, ["part", "seq"]).select("start", "payload").mapInArrow(work, "doc_id long, start long, n_tokens long, ids_crc32 long")

import tracemalloc
import zlib
from contextlib import contextmanager

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from barloom.llm import tokenfile
from barloom.scratch import BATCH, arrow_rows, scratch_dir

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def pair():
    plain = Tokenizer.from_file(PATH)
    plain.encode_special_tokens = True
    return tokenfile.encoder(PATH, 2), plain


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="ab'sS. ,!*|#é日²1\n\n\t\r   \x1c\xa0<|>", max_size=30), max_size=6))
def test_encoder_equals_the_tokenizer(pair, texts):
    encode, plain = pair
    assert [x.tolist() for x in encode(texts)] == [[*plain.encode(t, add_special_tokens=False).ids, 2] for t in texts]


def test_other_tokenizers_are_used_whole():
    path = public_tokenizers.path("word_bpe_49k.json")
    plain = Tokenizer.from_file(path)
    assert tokenfile.encoder(path, 7)(["Some words.\nMore"])[0].tolist() == [*plain.encode("Some words.\nMore", add_special_tokens=False).ids, 7]


def test_files_round_trip(spark, documents, pair):
    rows = [(k * 37 % 101, f"text {k} é\n\n more" * (k % 5)) for k in range(101)] + [(None, None), (3, ""), (3, ""), (500, "x" * 40_000)]
    path = scratch_dir(spark)
    tokenfile.write_token_files(documents(*rows).repartition(5), path, PATH, 2)
    got = [tuple(r) for r in tokenfile.read_token_files(spark, path).orderBy("start").collect()]
    assert [r[0] for r in got] == [None, *sorted(r[0] for r in rows if r[0] is not None)]
    texts = {}
    for i, t in rows:
        texts.setdefault(i, []).append(t or "")
    at = 0
    for i, start, n, crc in got:
        choices = {zlib.crc32(np.array([*pair[1].encode(t, add_special_tokens=False).ids, 2], "<u4").tobytes()) for t in texts[i]}
        assert start == at and crc in choices
        at += n


def test_shards_give_single_documents_and_know_their_dictionary(spark, documents):
    path = scratch_dir(spark)
    tokenfile.write_token_files(documents(*[(k, f"some text number {k}") for k in range(30)]), path, PATH, 2)
    dictionary = bytes(spark.read.parquet(f"{path}/dictionary").first()[0])
    payload = bytes(spark.read.parquet(f"{path}/shards").orderBy("part", "seq").first()["payload"])
    shard = tokenfile.Shard(payload, dictionary)
    assert Tokenizer.from_file(PATH).decode(shard.ids(1)[:-1].tolist()) == f"some text number {shard.doc_ids[1]}"
    with pytest.raises(ValueError, match="dictionary"):
        tokenfile.Shard(payload, dictionary + b"x")


def test_an_empty_table(spark, documents):
    path = scratch_dir(spark)
    tokenfile.write_token_files(documents((1, "a")).where("false"), path, PATH, 2)
    assert tokenfile.read_token_files(spark, path).count() == 0


def test_added_tokens_are_encoded_as_the_tokenizer_does(spark, documents):
    plain = Tokenizer.from_file(PATH)
    texts = ["end<|endoftext|> go", "<|endoftext|>", "a\n<|endoftext|><|endoftext|>\nb c.", "no <|endoftext |> here", "end go", ""]
    want = [[*plain.encode(t, add_special_tokens=False).ids, 2] for t in texts]
    assert want[0] == [437, 50256, 467, 2]
    assert [x.tolist() for x in tokenfile.encoder(PATH, 2)(texts)] == want
    path = scratch_dir(spark)
    tokenfile.write_token_files(documents(*enumerate(texts)), path, PATH, 2)
    got = [(r["start"], r["n_tokens"], r["ids_crc32"]) for r in tokenfile.read_token_files(spark, path).orderBy("doc_id").collect()]
    sizes = [len(x) for x in want]
    assert got == [(sum(sizes[:k]), len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for k, x in enumerate(want)]


def test_a_word_is_remembered_once_whatever_signs_follow():
    encode, plain = tokenfile.encoder.__wrapped__(PATH, 2), Tokenizer.from_file(PATH)
    words = ["".join(chr(97 + k // 26**n % 26) for n in range(4)) for k in range(0, 26**4, 200)]
    texts = [" ".join(w + sign for w in words) for sign in ("", *tokenfile.TAIL)]
    want = [[*plain.encode(t, add_special_tokens=False).ids, 2] for t in texts]
    encode(["start"])
    tracemalloc.start()
    try:
        same = [encode([t])[0].tolist() == x for t, x in zip(texts, want, strict=True)]
        kept = tracemalloc.get_traced_memory()[0]
    finally:
        tracemalloc.stop()
    assert all(same)
    assert kept < 400 * len(words)


def test_writing_gives_workers_few_rows_at_once(spark, documents, monkeypatch):
    seen = []

    @contextmanager
    def spied(session, rows):
        with arrow_rows(session, rows):
            seen.append(max(r["n"] for r in spark.range(5000, numPartitions=1).mapInArrow(lambda batches: (pa.RecordBatch.from_arrays([pa.array([b.num_rows])], names=["n"]) for b in batches), "n long").collect()))
            yield

    monkeypatch.setattr(tokenfile, "arrow_rows", spied)
    before = spark.conf.get(BATCH)
    tokenfile.write_token_files(documents((1, "a")), scratch_dir(spark), PATH, 2, pieces_kept=10)
    assert seen == [tokenfile.ROWS]
    assert spark.conf.get(BATCH) == before

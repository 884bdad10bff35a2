"""What the class language model keeps on disk, and that its parts and chunks change nothing."""

import os
import random
import tempfile
import time
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from barloom import scratch
from barloom.llm import brown


def texts(n, seed=0):
    rng = random.Random(seed)
    words = [f"{a}{k}" for a in ("ab", "Cé", "xyz") for k in range(60)]
    return [(k, " ".join(rng.choice(words[: rng.choice((4, 40, 180))]) for _ in range(rng.randrange(50)))) for k in range(n)]


def shuffle_files():
    local = os.environ.get("SPARK_LOCAL_DIRS", tempfile.gettempdir()).split(",")
    return {p for d in local for p in Path(d).glob("**/blockmgr-*/*/shuffle_*.data")}


def test_settled_tables_leave_no_shuffle_files(spark):
    before = shuffle_files()
    settled = scratch.settle(spark.range(20_000).groupBy((F.col("id") % 7000).alias("k")).count())
    for _ in range(40):
        if not (left := shuffle_files() - before):
            break
        time.sleep(0.25)
    assert not left and settled.count() == 7000 and spark.conf.get(scratch.CLEANUP, None) is None


def test_sweeps_leave_no_tables_of_parts(spark, documents, monkeypatch, tmp_path):
    made = []
    monkeypatch.setattr(scratch, "scratch_dir", lambda s: made.append(f"{tmp_path}/{len(made)}") or made[-1])
    rows = documents(*texts(40))
    assert brown.brown_scores(rows, F.col("doc_id") % 4 != 0, classes=4).count() == 40
    left = [set(spark.read.parquet(p).columns) for p in made]
    assert not any(c & {"core_n", "at", "got", "own"} for c in left) and any("base" in c for c in left)


def test_parts_of_the_words_change_no_score(documents, monkeypatch):
    rows = documents(*texts(60, 1), (None, None), (70, "ab1"), (70, "ab1"))
    score = lambda: sorted((r["doc_id"] or -1, r["n_tokens"], r["n_known"], round(r["base_score"], 6), round(r["score"], 6)) for r in brown.brown_scores(rows, F.coalesce(F.col("doc_id") % 4 != 0, F.lit(True)), classes=4).collect())
    monkeypatch.setattr(brown, "FREQUENT", 20)
    monkeypatch.setattr(brown, "TYPES", 9)
    whole = score()
    monkeypatch.setattr(brown, "PART_TOKENS", 90)
    assert score() == whole and len(whole) == 63


@pytest.mark.parametrize("parts", [1, 5])
def test_neighbours_are_counted_in_parts(spark, parts):
    """Over chunks of a few texts: the words of all parts with the neighbours that a count over the tokens finds."""
    rows = [t for _, t in texts(30, 2)] + ["ab1 ab1 ab1 Cé9 Cé9", "", None]
    core = {b"": 0, b"ab0": 1, b"ab1": 2}
    want, cells = Counter(), 0
    for t in rows:
        own = brown.tokens(t)
        cells += len(own)
        for a, b in zip([b"", *own], own, strict=False):
            if b not in core:
                want[brown.word_key(b), 0, core[a] if a in core else brown.word_key(a)] += 1
            if a not in core and a != b:
                want[brown.word_key(a), 1, core[b] if b in core else brown.word_key(b)] += 1
    made = [r.asDict() for r in brown.word_parts(spark.createDataFrame([(t,) for t in rows], "text string"), core, 3, parts, 200).collect()]
    asked = {}
    for r in sorted((r for r in made if r["asks"] is not None), key=lambda r: r["part"]):
        asked.setdefault(r["asks"], []).append(np.frombuffer(r["keys"], np.int64))
    got = Counter()
    for r in made:
        if r["core_n"] is None:
            continue
        keys, others = np.frombuffer(r["keys"], np.int64), np.concatenate([np.empty(0, np.int64), *asked.get(r["part"], [])])
        assert set((keys % parts).tolist()) == {r["part"]} and (np.diff(keys) > 0).all()
        for k, code, n in zip(np.repeat(keys, brown.unpacked(r["core_n"])).tolist(), brown.unpacked(r["core"]).tolist(), brown.unpacked(r["core_c"]).tolist(), strict=True):
            got[k, code // 3, code % 3] += n
        sides = np.repeat(np.arange(2 * len(keys)), brown.unpacked(r["loose_n"]))
        for s, at, n in zip(sides.tolist(), brown.unpacked(r["loose"]).tolist(), brown.unpacked(r["loose_c"]).tolist(), strict=True):
            got[int(keys[s // 2]), s % 2, int(others[at])] += n
        for k, n in zip(keys.tolist(), brown.unpacked(r["same"]).tolist(), strict=True):
            got[k, 0, k] += n
    assert +got == want and sum(int(brown.unpacked(r["cells_c"]).sum()) for r in made if r["cells"] is not None) == cells


def test_tokens_of_joined_texts():
    rng = random.Random(3)
    pieces = [b"a", b"B", b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r", b"\x1c", b"\x85", "É ".encode(), b"\x00"]
    for _ in range(200):
        rows = [b"".join(rng.choice(pieces) for _ in range(rng.randrange(9))) for _ in range(rng.randrange(1, 5))]
        codes, words = brown.coded(rows)
        assert [words[k] for k in codes] == [b"", *(w for t in rows for w in [*t.lower().split(), b""])]

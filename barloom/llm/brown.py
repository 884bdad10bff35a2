"""Language-model scoring by a class-based bigram model (Brown classes found by exchange).

All counts are over all training texts, and every word of them has a class found by exchange, however rare it is. It
starts on the driver: the most frequent words (the core) are types of their own, all others share a type by their
spelling (a hash of their last two bytes), and the exchange algorithm assigns types to classes so that the class
bigrams keep the most mutual information. Then Spark sweeps over all words outside the core: each goes to the class
that gains the most by the word's own neighbours. The driver holds classes by classes; a sweep that lowers the mutual information is undone.
A text's probability is the product over its tokens of

    P(class | class before) * P(word | class)

with Witten-Bell smoothing of the classes' transitions and absolute discounting of a class's words, which leaves a
share for the unknown words. An unknown word takes the class that most words seen once of its spelling have; all unknown words
of a spelling are one type.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.scratch import clear, settle, settle_at

#: Words of the core, types by spelling that all others start from, classes.
TYPES, SHAPES, CLASSES = 1023, 256, 48
#: Sweeps over the words outside the core, at most; the share of mutual information that a sweep must gain for another one.
SWEEPS, GAIN = 4, 1e-3
#: Seed of Spark's own 64-bit hash, by which words outside the core are known to the sweeps.
SEED = 42
#: Words whose counts every task has at hand; all others are looked up by a join.
FREQUENT = 50_000
#: Bytes of text that a task counts at once; training tokens for each part of the words outside the core, at about.
CHUNK_BYTES, PART_TOKENS = 6 << 20, 2_000_000
#: Counts whose gains a sweep looks up; those of larger counts are computed one by one.
LOOKED_UP = 16
END = b""
#: Stands for the end between joined texts; UTF-8 has no such byte.
_BREAK = b" \xff "


def tokens(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case, and one end."""
    return [*(text or "").encode("utf-8", "replace").lower().split(), END]


def shape(word: bytes) -> int:
    return zlib.crc32(word[-2:]) % SHAPES


def coded(texts: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
    """The tokens of some texts in a row as numbers of their words, and the words; an end comes before all of them."""
    joined = _BREAK.join([b"", *texts, b""]).strip().lower()
    whole = pa.Array.from_buffers(pa.string(), 1, [None, pa.py_buffer(np.array([0, len(joined)], np.int32)), pa.py_buffer(joined)])
    tokens = pc.ascii_split_whitespace(whole).values.view(pa.binary()).dictionary_encode()
    words = tokens.dictionary.to_pylist()
    words[0] = END
    return tokens.indices.to_numpy(), words


def _chunks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[np.ndarray, list[bytes], list[pa.RecordBatch]]]:
    """The coded tokens of the column ``text``, about ``size`` bytes of it at once, with its rows."""
    texts, rows, now = [], [], 0
    for batch in (part for whole in batches for part in _slices(whole)):
        start = 0
        for k, text in enumerate(batch.column("text").to_pylist(), 1):
            texts.append((text or "").encode("utf-8", "replace"))
            now += len(texts[-1]) + 1
            if now >= size or k == batch.num_rows:
                rows.append(batch.slice(start, k - start))
                start = k
            if now >= size:
                yield *coded(texts), rows
                texts, rows, now = [], [], 0
                pa.default_memory_pool().release_unused()
    if texts:
        yield *coded(texts), rows


def token_counts(texts: DataFrame, chunk: int = CHUNK_BYTES) -> DataFrame:
    """``word`` (binary) and ``c`` over all rows of the column ``text``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for codes, words, _ in _chunks(batches, chunk):
            n = np.bincount(codes[1:], minlength=len(words))
            yield from pa.Table.from_arrays([pa.array(words, pa.binary()), pa.array(n)], names=["word", "n"]).to_batches(max_chunksize=1 << 16)

    return texts.select("text").mapInArrow(work, "word binary, n long").groupBy("word").agg(F.sum("n").alias("c"))


def _runs(values: list, start: int, stop: int) -> Iterator[tuple[int, int]]:
    """The ranges of equal values from ``start`` to ``stop``."""
    while start < stop:
        end = bisect_right(values, values[start], start, stop)
        yield start, end
        start = end


def _slices(batch: pa.RecordBatch, rows: int = 1024) -> Iterator[pa.RecordBatch]:
    for k in range(0, batch.num_rows, rows):
        yield batch.slice(k, rows)


def word_key(word: bytes) -> int:
    """What Spark's xxhash64 gives for a binary value."""
    x = xxhash.xxh64_intdigest(word, SEED)
    return x - (1 << 64) if x >> 63 else x


def packed(x: np.ndarray) -> bytes:
    """Numbers that are not below zero, in the smallest type that holds them."""
    kind = np.min_scalar_type(int(x.max()) if len(x) else 0)
    return kind.char.encode() + x.astype(kind).tobytes()


def unpacked(x: bytes) -> np.ndarray:
    return narrow(x).astype(np.int64)


def narrow(x: bytes) -> np.ndarray:
    """The same in the type that they were packed in."""
    return np.frombuffer(x, x[:1].decode(), offset=1)


def summed(code: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different codes, ascending, and the sums of their numbers."""
    order = np.argsort(code, kind="stable")
    code, n = code[order], n[order]
    first = np.flatnonzero(np.r_[True, code[1:] != code[:-1]]) if len(code) else np.empty(0, np.int64)
    return code[first], np.add.reduceat(n, first) if len(first) else n


#: Rows of parts: ``keys`` of the part's words (ascending), their ``shape``, and by word the neighbours in the core (``core``: the number, from ``cores`` on for those after
#: the word; ``core_c``: how often; ``core_n``: how many entries each word has) and outside (``loose``, by word and side). Rows that ask: the words of ``part`` that the part ``asks`` must know.
_PACKED = ("keys", "shape", "core_n", "core", "core_c", "loose_n", "loose", "loose_c", "same", "cells", "cells_c")
_PART_ROWS = "part int, asks int, " + ", ".join(f"{c} binary" for c in _PACKED)


def _rows(rows: list[dict]) -> pa.RecordBatch:
    columns = [pa.array([r.get(c) for r in rows], pa.int32()) for c in ("part", "asks")]
    return pa.RecordBatch.from_arrays([*columns, *[pa.array([r.get(c) for r in rows], pa.binary()) for c in _PACKED]], names=["part", "asks", *_PACKED])


def chunk_parts(codes: np.ndarray, words: list[bytes], core: dict[bytes, int], cores: int, parts: int) -> tuple[np.ndarray, list[dict]]:
    """The types of a chunk's words, and for each part its words outside the core with their neighbours (by key where they are loose)."""
    number = np.array([core.get(w, -1) for w in words], np.int64)
    spelled = np.array([-1 if n >= 0 else shape(w) for w, n in zip(words, number.tolist(), strict=True)], np.int64)
    types = np.where(number >= 0, number, cores + spelled)
    rare = np.flatnonzero(number < 0)
    key = np.array([word_key(words[k]) for k in rare.tolist()], np.int64)
    order = np.lexsort((key, key % parts))
    rare, key = rare[order], key[order]
    place = np.full(len(words), -1, np.int64)
    place[rare] = np.arange(len(rare))
    at = np.flatnonzero(number[codes] < 0)
    own = place[codes[at]]
    sides = [codes[at - 1], codes[at + 1]]
    in_core = [np.flatnonzero(number[x] >= 0) for x in sides]
    near = np.concatenate([own[k] * 2 * cores + side * cores + number[x[k]] for side, (x, k) in enumerate(zip(sides, in_core, strict=True))])
    near, near_c = np.unique(near, return_counts=True)
    # A word after itself is counted once, as before itself.
    outside = [np.flatnonzero((number[x] < 0) & ((place[x] != own) | (side == 0))) for side, x in enumerate(sides)]
    far = np.concatenate([(own[k] * 2 + side) * len(rare) + place[x[k]] for side, (x, k) in enumerate(zip(sides, outside, strict=True))])
    far, far_c = np.unique(far, return_counts=True)
    near_word, near = near // (2 * cores), near % (2 * cores)
    far_word, far = far // max(len(rare), 1), key[far % max(len(rare), 1)]
    heads = np.searchsorted(key % parts, np.arange(parts + 1))
    near_at, far_at = np.searchsorted(near_word, heads), np.searchsorted(far_word, 2 * heads)
    found = []
    for p in np.flatnonzero(np.diff(heads)).tolist():
        (a, b), (c, d), (e, f) = heads[p : p + 2], near_at[p : p + 2], far_at[p : p + 2]
        found.append(
            {
                "part": p,
                "keys": key[a:b].tobytes(),
                "shape": packed(spelled[rare[a:b]]),
                "core_n": packed(np.bincount(near_word[c:d] - a, minlength=b - a)),
                "core": packed(near[c:d]),
                "core_c": packed(near_c[c:d]),
                "loose_n": packed(np.bincount(far_word[e:f] - 2 * a, minlength=2 * (b - a))),
                "loose": far[e:f].tobytes(),
                "loose_c": packed(far_c[e:f]),
            }
        )
    return types, found


def joined_part(part: int, rows: list[dict], cores: int, parts: int) -> list[dict]:
    """A part's rows as one, its loose neighbours numbered by their parts and keys, and the rows that ask for these."""
    found = []
    cells = [r for r in rows if r["cells"] is not None]
    if cells:
        code, n = summed(*(np.concatenate([unpacked(r[c]) for r in cells]) for c in ("cells", "cells_c")))
        found.append({"part": part, "cells": packed(code), "cells_c": packed(n)})
    rows = [r for r in rows if r["keys"] is not None]
    if not rows:
        return found
    parted = [np.frombuffer(r["keys"], np.int64) for r in rows]
    keys, first, word = np.unique(np.concatenate(parted), return_index=True, return_inverse=True)
    near, far = [], []
    start = 0
    for r, mine in zip(rows, parted, strict=True):
        mine, start = word[start : start + len(mine)], start + len(mine)
        near.append(np.repeat(mine, unpacked(r["core_n"])) * 2 * cores + unpacked(r["core"]))
        far.append(np.repeat((2 * mine[:, None] + np.arange(2)).ravel(), unpacked(r["loose_n"])))
    shapes = np.concatenate([unpacked(r["shape"]) for r in rows])[first]
    near, near_c = summed(np.concatenate(near), np.concatenate([unpacked(r["core_c"]) for r in rows]))
    far, far_c = np.concatenate(far), np.concatenate([unpacked(r["loose_c"]) for r in rows])
    other = np.concatenate([np.frombuffer(r["loose"], np.int64) for r in rows])
    itself = other == keys[far // 2]
    same = np.zeros(len(keys), np.int64)
    np.add.at(same, far[itself] // 2, far_c[itself])
    far, far_c, other = far[~itself], far_c[~itself], other[~itself]
    asked, at = np.unique(other, return_inverse=True)
    order = np.argsort(asked % parts, kind="stable")
    asked, rank = asked[order], np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    far, far_c = summed(far * max(len(asked), 1) + rank[at], far_c)
    near_word, far_word = near // (2 * cores), far // max(len(asked), 1)
    found.append(
        {
            "part": part,
            "keys": keys.tobytes(),
            "shape": packed(shapes),
            "core_n": packed(np.bincount(near_word, minlength=len(keys))),
            "core": packed(near % (2 * cores)),
            "core_c": packed(near_c),
            "loose_n": packed(np.bincount(far_word, minlength=2 * len(keys))),
            "loose": packed(far % max(len(asked), 1)),
            "loose_c": packed(far_c),
            "same": packed(same),
        }
    )
    heads = np.searchsorted(asked % parts, np.arange(parts + 1))
    return found + [{"part": p, "asks": part, "keys": asked[heads[p] : heads[p + 1]].tobytes()} for p in np.flatnonzero(np.diff(heads)).tolist()]


def word_parts(texts: DataFrame, core: dict[bytes, int], cores: int, parts: int, chunk: int = CHUNK_BYTES) -> DataFrame:
    """Over the column ``text``: a row for each part of the words outside the core, with their neighbours; rows that ask other parts; the
    bigrams of types as ``cells``. A word's part is its key modulo ``parts``."""
    width = cores + SHAPES

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width * width, np.int64)
        for codes, words, _ in _chunks(batches, chunk):
            types, found = chunk_parts(codes, words, core, cores, parts)
            of = types[codes]
            total += np.bincount(of[:-1] * width + of[1:], minlength=len(total))
            if found:
                yield _rows(found)
        at = np.flatnonzero(total)
        by = at // width % parts
        if len(at):
            yield _rows([{"part": p, "cells": packed(at[by == p]), "cells_c": packed(total[at[by == p]])} for p in np.unique(by).tolist()])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(_each(batches))
        if held:
            yield _rows(joined_part(held[0]["part"], held, cores, parts))

    counted = texts.select("text").mapInArrow(count, _PART_ROWS)
    return dealt(counted, parts).mapInArrow(join, _PART_ROWS)


def dealt(rows: DataFrame, parts: int) -> DataFrame:
    """Rows by their part, a partition for each part."""
    return rows.repartitionById(parts, F.col("part"))


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield batch.slice(k, 1).to_pylist()[0]


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """The rows of a partition, which are of one part, as one."""
    row: dict = {}
    for more in _each(batches):
        row |= {k: x for k, x in more.items() if x is not None}
    if "keys" in row or "core" in row:
        yield {"got": None} | row


def g(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1.0))


def information(table: np.ndarray) -> float:
    """The mutual information of class bigrams, but for a constant and a factor."""
    return float(g(table).sum() - g(table.sum(0)).sum() - g(table.sum(1)).sum())


def exchange_classes(bigrams: np.ndarray, classes: int, sweeps: int = 10) -> np.ndarray:
    """The class of each type. The types start in turn by frequency; each sweep moves every type to the class that
    gains the most mutual information, until none moves."""
    bigrams = bigrams.astype(float)
    weight = bigrams.sum(0) + bigrams.sum(1)
    order = np.argsort(-weight, kind="stable")
    owner = np.zeros(len(bigrams), int)
    owner[order] = np.arange(len(order)) % classes
    table = np.zeros((classes, classes))
    np.add.at(table, (owner[:, None], owner[None, :]), bigrams)

    for _ in range(sweeps):
        moved = 0
        for w in order:
            if not weight[w]:
                break
            old, self_count = owner[w], bigrams[w, w]
            out = np.bincount(owner, bigrams[w], classes)
            into = np.bincount(owner, bigrams[:, w], classes)
            out[old] -= self_count
            into[old] -= self_count
            table[old] -= out
            table[:, old] -= into
            table[old, old] -= self_count
            np.maximum(table, 0, out=table)
            rows, columns, diagonal = table.sum(1), table.sum(0), np.diagonal(table)
            gain = (g(table + out) - g(table)).sum(1) + (g(table + into[:, None]) - g(table)).sum(0)
            gain += g(diagonal + out + into + self_count) - g(diagonal + out) - g(diagonal + into) + g(diagonal)
            gain -= g(rows + out.sum() + self_count) - g(rows) + g(columns + into.sum() + self_count) - g(columns)
            new = int(np.argmax(gain))
            if gain[new] <= gain[old] + 1e-9:
                new = old
            owner[w] = new
            table[new] += out
            table[:, new] += into
            table[new, new] += self_count
            moved += new != old
        if not moved:
            break
    return owner


def contexts(row: dict, core: np.ndarray, classes: int, heard: bool = True) -> tuple[np.ndarray, ...]:
    """Of a part's row with the classes that it was told: the words' own classes, and of each count of a word its place, its kind (the class before the word,
    from ``classes`` on the class after it, twice ``classes`` for the word itself), the count, and whether its bigram is found here rather than in the other word's row.
    Of a row that was not ``heard`` yet, only the sides of the kinds count."""
    own, few = unpacked(row["own"]), np.int32
    told = np.concatenate([np.empty(0, few), *[narrow(x["told"]).astype(few) for x in row["got"] or ()]])
    place = np.repeat(np.arange(len(own), dtype=few), narrow(row["core_n"]))
    side = np.repeat(np.arange(2 * len(own), dtype=few), narrow(row["loose_n"]))
    same = narrow(row["same"])
    twice = np.flatnonzero(same).astype(few)
    # What each entry in the core adds: the class, and as many as there are classes for one after the word.
    of_core = np.concatenate((core, classes + core)).astype(few)
    return (
        own,
        np.concatenate((place, side >> 1, twice)),
        np.concatenate((of_core[narrow(row["core"])], (side & 1) * few(classes) + (told[narrow(row["loose"])] if heard else few(0)), np.full(len(twice), 2 * classes, few))),
        np.concatenate((narrow(row["core_c"]), narrow(row["loose_c"]), same[twice])),
        np.concatenate((np.ones(len(place), bool), (side & 1) == 1, np.ones(len(twice), bool))),
    )


def class_table(told: DataFrame, core: np.ndarray, classes: int) -> np.ndarray:
    """The class bigrams with at least one word outside the core, each once: those after such a word, and those after a core word."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(classes * classes, np.int64)
        for row in _whole(batches):
            own, place, kind, n, here = contexts(row, core, classes)
            own, kind, n = own[place[here]], kind[here], n[here]
            cell = np.where(kind < classes, kind.astype(np.int64) * classes + own, own * classes + np.where(kind == 2 * classes, own, kind - classes))
            table += np.bincount(cell, n, len(table)).astype(np.int64)
        at = np.flatnonzero(table)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(table[at])], names=["cell", "n"])

    table = np.zeros(classes * classes)
    for r in settle(told.mapInArrow(work, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))).collect():
        table[r["cell"]] = r["n"]
    return table.reshape(classes, classes)


def moved_words(told: DataFrame, table: np.ndarray, core: np.ndarray, classes: int, words: int = 4096) -> DataFrame:
    """``part`` and ``own``: of each word the class that gains the most mutual information from its neighbours, where the table is
    taken without the word's own counts in its own class. A word stays where no class gains more."""
    kinds = 2 * classes + 1

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, columns, diagonal = table.sum(1), table.sum(0), np.diagonal(table)
        # The cells that a count adds to, by class: [left classes, then right classes, then the diagonal].
        cells = np.concatenate((table, table.T, diagonal[None, :]))
        small = np.stack([g(cells + n) - g(cells) for n in range(LOOKED_UP + 1)])

        def better(own: np.ndarray, place: np.ndarray, kind: np.ndarray, n: np.ndarray) -> np.ndarray:
            gain = small[np.minimum(n, LOOKED_UP).astype(np.int64), kind]
            large = np.flatnonzero(n > LOOKED_UP)
            gain[large] = g(cells[kind[large]] + n[large, None]) - g(cells[kind[large]])
            mine = own[place]
            held = cells[kind, mine]
            gain[np.arange(len(n)), mine] = g(held) - g(np.maximum(held - n, 0))
            at = np.arange(len(own))
            total = np.add.reduceat(gain, np.searchsorted(place, at))
            after = np.bincount(place, np.where(kind >= classes, n, 0), len(own))
            before = np.bincount(place, np.where((kind < classes) | (kind == 2 * classes), n, 0), len(own))
            for sums, size in ((rows, after), (columns, before)):
                # Most words are rare, so few sizes are different.
                sizes, back = np.unique(size, return_inverse=True)
                more = (g(sums + sizes[:, None]) - g(sums))[back]
                more[at, own] = g(sums[own]) - g(np.maximum(sums[own] - size, 0))
                total -= more
            best = np.argmax(total, 1)
            return np.where(total[at, best] > total[at, own] + 1e-9, best, own)

        for row in _whole(batches):
            own, place, kind, n, _ = contexts(row, core, classes)
            new = own.copy()
            order = np.argsort(place, kind="stable")
            ends = np.searchsorted(place[order], np.arange(0, len(own) + words, words))
            for k, (a, b) in enumerate(zip(ends[:-1], ends[1:], strict=True)):
                part, some = slice(k * words, (k + 1) * words), order[a:b]
                counts = np.bincount((place[some].astype(np.int64) - k * words) * kinds + kind[some], n[some])
                at = np.flatnonzero(counts)
                new[part] = better(own[part], at // kinds, at % kinds, counts[at])
            yield pa.RecordBatch.from_arrays([pa.array([row["part"]], pa.int32()), pa.array([packed(new)], pa.binary())], names=["part", "own"])

    return told.mapInArrow(work, "part int, own binary")


def exchange_words(parts: DataFrame, in_parts: int, start: np.ndarray, core: np.ndarray, core_table: np.ndarray, sweeps: int = SWEEPS) -> tuple[DataFrame, np.ndarray, list[float]]:
    """``key`` and ``class`` of all words outside the core (``c`` and ``shape`` too), the class bigrams, and the mutual information at the start and after each sweep.

    ``parts``: the rows of ``word_parts`` with ``in_parts`` parts. ``start``: by spelling, the class that a word starts from. ``core``
    has the core's classes, which stay, and ``core_table`` the class bigrams within the core. In a sweep a part is told the classes of its words' neighbours, one small
    number for each neighbour, in the order in which it asked for them once.
    """
    classes = len(core_table)
    spark = parts.sparkSession
    own = parts.where("core_n IS NOT NULL").drop("asks", "cells", "cells_c")

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = None
        for row in _each(batches):
            mine = np.frombuffer(row["keys"], np.int64)
            if row["asks"] < 0:
                keys = mine
            else:
                arrays = [pa.array([row[c]], pa.int32()) for c in ("part", "asks")]
                yield pa.RecordBatch.from_arrays([*arrays, pa.array([packed(np.searchsorted(keys, mine))], pa.binary())], names=["part", "asks", "at"])

    def begin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _each(batches):
            yield pa.RecordBatch.from_arrays([pa.array([row["part"]], pa.int32()), pa.array([packed(start[unpacked(row["shape"])])], pa.binary())], names=["part", "own"])

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _each(batches):
            arrays = [pa.array([row[c]], pa.int32()) for c in ("asks", "part")]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array([packed(unpacked(row["own"])[unpacked(row["at"])])], pa.binary())], names=["part", "source", "told"])

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _whole(batches):
            own, place, kind, n, _ = contexts(row, core, classes, False)
            left = (kind < classes) | (kind == 2 * classes)
            c = np.bincount(place[left], n[left], len(own)).astype(np.int64)
            whole = pa.table({"key": np.frombuffer(row["keys"], np.int64), "class": own.astype(np.int32), "c": c, "shape": unpacked(row["shape"]).astype(np.int32)})
            yield from whole.to_batches(max_chunksize=1 << 16)

    asked = own.select("part", F.lit(-1).alias("asks"), "keys").unionByName(parts.where("asks IS NOT NULL").select("part", "asks", "keys"))
    routes, of_routes = settle_at(dealt(asked, in_parts).sortWithinPartitions("asks").mapInArrow(route, "part int, asks int, at binary"))
    owners, of_owners = settle_at(own.select("part", "shape").mapInArrow(begin, "part int, own binary"))
    kept, told_so_far, cleared = None, [], [of_routes]
    for sweep in range(sweeps + 1):
        sent = routes.join(owners, "part").mapInArrow(tell, "part int, source int, told binary")
        got = sent.groupBy("part").agg(F.array_sort(F.collect_list(F.struct("source", "told"))).alias("got"))
        received, of_received = settle_at(owners.join(got, "part", "left"))
        cleared += [of_owners, of_received]
        told = dealt(own.drop("keys", "shape").unionByName(received, allowMissingColumns=True), in_parts)
        table = core_table + class_table(told, core, classes)
        now = information(table)
        if kept is not None and now <= told_so_far[-1]:
            break
        kept = owners, table
        told_so_far.append(now)
        if sweep == sweeps or (sweep and now - told_so_far[-2] <= GAIN * abs(now - told_so_far[0])):
            break
        owners, of_owners = settle_at(moved_words(told, table, core, classes))
    classed = settle(dealt(own.unionByName(kept[0], allowMissingColumns=True), in_parts).mapInArrow(spread, "key long, class int, c long, shape int"))
    clear(spark, cleared)
    return classed, kept[1], told_so_far


def transitions(table: np.ndarray, members: np.ndarray) -> np.ndarray:
    """log10 P(class | class before), smoothed with the classes' own shares, to which ``members`` are added."""
    alone = (table.sum(0) + members) / (table.sum() + members.sum())
    followers = (table > 0).sum(1)
    seen = table.sum(1)
    smooth = np.where(seen + followers > 0, followers / np.maximum(seen + followers, 1), 1.0)[:, None]
    with np.errstate(divide="ignore"):
        return np.log10((1 - smooth) * table / np.maximum(seen, 1)[:, None] + smooth * alone)


def word_shares(tokens_of: np.ndarray, words_of: np.ndarray, single: np.ndarray, twice: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """How a class's probability is dealt to its words, from the tokens and words of each class, the words seen once by spelling and class, and
    how many words are seen twice: what is taken off each word's count, by class; the class of the unknown words of each spelling; and
    log10 of the share that these have in a class.

    All unknown words of a spelling are one type. The types of a class share what is taken off its words' counts, so the shares of its
    words and of its types add up to one; from a class that has none nothing is taken off.
    """
    once = single.sum()
    discount = min(max(once / (once + 2 * twice), 0.1), 0.9) if once else 0.5
    unknown_class = np.where(single.any(1), single.argmax(1), single.sum(0).argmax())
    kinds = np.bincount(unknown_class, minlength=len(tokens_of))
    taken = np.where(kinds > 0, discount, 0.0)
    reserve = np.where(tokens_of > 0, discount * words_of / np.maximum(tokens_of, 1), 1.0)
    with np.errstate(divide="ignore"):
        return taken, unknown_class, np.log10(reserve / np.maximum(kinds, 1))


def brown_scores(documents: DataFrame, trained: Column, id_col: str = "doc_id", text_col: str = "text", classes: int = CLASSES) -> DataFrame:
    """One row for each row of ``documents``: ``doc_id``, ``trained``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` (the
    unigram model with one added to each count) and ``score``; ``trained`` says which rows to learn from.

    Null texts are empty: one token, the end. With nothing to learn from all tokens are unknown.
    Repeated rows stay rows of their own.
    """
    spark = documents.sparkSession
    rows = documents.select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(trained, F.lit(False)).alias("trained"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    training = rows.where("trained")
    counts = settle(token_counts(training))
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    common = counts.where("length(word) > 0").orderBy(F.desc("c"), "word").limit(FREQUENT).collect()
    ends = counts.where("length(word) = 0").first()
    frequent = {END: 0} | {bytes(r["word"]): k + 1 for k, r in enumerate(common)}
    known = np.array([ends["c"] if ends else 0, *[r["c"] for r in common]], float)
    keys = np.array([k if k <= TYPES else word_key(w) for w, k in frequent.items()], np.int64)
    shared = spark.sparkContext.broadcast(frequent)

    cores = TYPES + 1
    width = cores + SHAPES
    in_parts = max(1, -(-total // PART_TOKENS))
    in_core = {w: k for w, k in frequent.items() if k < cores}
    parts, of_parts = settle_at(word_parts(training, in_core, cores, in_parts))
    bigrams = np.zeros(width * width)
    for r in parts.where("cells IS NOT NULL").select("cells", "cells_c").toArrow().to_pylist():
        bigrams[unpacked(r["cells"])] = unpacked(r["cells_c"])
    bigrams = bigrams.reshape(width, width)
    owner = exchange_classes(bigrams, classes)
    core = owner[:cores]
    core_table = np.zeros((classes, classes))
    np.add.at(core_table, (core[:, None], core[None, :]), bigrams[:cores, :cores])

    # All other words start in the class of their spelling.
    members, table, _ = exchange_words(parts, in_parts, owner[cores:], core, core_table)
    clear(spark, [of_parts])

    # Tokens and words of each class, and the words that occur once by spelling and class.
    tokens_of, words_of, single = np.zeros(classes), np.zeros(classes), np.zeros((SHAPES, classes))
    twice = 0
    for r in members.groupBy("shape", "class").agg(F.sum("c").alias("t"), F.count("*").alias("v"), F.count_if(F.col("c") == 1).alias("n1"), F.count_if(F.col("c") == 2).alias("n2")).collect():
        tokens_of[r["class"]] += r["t"]
        words_of[r["class"]] += r["v"]
        single[r["shape"], r["class"]] += r["n1"]
        twice += r["n2"]
    for w, k in frequent.items():
        if k <= TYPES and known[k]:
            tokens_of[core[k]] += known[k]
            words_of[core[k]] += 1
            single[shape(w), core[k]] += known[k] == 1
            twice += known[k] == 2
    taken, unknown_class, left = word_shares(tokens_of, words_of, single, twice)
    # The frequent words' classes and probabilities within them.
    class_of = np.concatenate((core, np.zeros(max(len(known) - TYPES - 1, 0), int)))[: len(known)]
    if len(known) > TYPES + 1:
        number = spark.createDataFrame([(int(x), k + TYPES + 1) for k, x in enumerate(keys[TYPES + 1 :])], "key long, number int")
        for r in members.join(F.broadcast(number), "key").select("number", "class").collect():
            class_of[r["number"]] = r["class"]
    in_class = np.where(known > 0, np.log10(np.maximum(known - taken[class_of], 1e-9) / np.maximum(tokens_of[class_of], 1)), left[class_of])
    chance = transitions(table, np.ones(classes))
    local = spark.sparkContext.broadcast((chance, class_of, np.log10(known + 1), known > 0, in_class, unknown_class, left))

    kind = rows.schema["doc_id"].dataType.simpleString()
    sums = ["n_tokens", "n_known", "base", "score"]
    lists = {"doc_id": kind, "trained": "boolean"} | dict(zip(sums, ("long", "long", "double", "double"), strict=True))
    blobs = ["spelled", "rare_n", "rare", "before", "after", "keys", "class", "c"]
    schema = "chunk long, part int, " + ", ".join([f"{c} array<{t}>" for c, t in lists.items()] + [f"{c} binary" for c in blobs])

    def made(found: list[dict], chunk: int, ids: pa.Array, trained: pa.Array) -> pa.RecordBatch:
        kinds = {"chunk": pa.int64(), "part": pa.int32()} | {c: pa.binary() for c in blobs}
        arrays = {c: pa.array([r.get(c, chunk if c == "chunk" else None) for r in found], t) for c, t in kinds.items()}
        numbers = {c: pa.array(found[0][c], t) for c, t in zip(sums, (pa.int64(), pa.int64(), pa.float64(), pa.float64()), strict=True)}
        for c, x in ({"doc_id": ids, "trained": trained} | numbers).items():
            mask = pa.array([False] + [True] * (len(found) - 1))
            arrays[c] = pa.ListArray.from_arrays(pa.array([0] + [len(x)] * len(found), pa.int32()), x, mask=mask)
        names = ["chunk", "part", *lists, *blobs]
        return pa.RecordBatch.from_arrays([arrays[c] for c in names], names=names)

    def begin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each chunk of documents: the sums over the frequent words, and the others with the classes beside them. Rows that ask each part for these words."""
        numbers_of = shared.value
        chance, class_of, log_count, is_known, in_class, _, _ = local.value
        task = TaskContext.get().partitionId() << 32
        for chunk, (codes, words, held) in enumerate(_chunks(batches, CHUNK_BYTES), task):
            number = np.array([numbers_of.get(w, -1) for w in words], np.int64)
            near = number >= 0
            of = lambda x: np.where(near, x[number], 0)  # noqa: B023, E731
            rare = np.flatnonzero(~near)
            key = np.array([word_key(words[k]) for k in rare.tolist()], np.int64)
            order = np.lexsort((key, key % in_parts))
            rare, key = rare[order], key[order]
            place = np.full(len(words), -1, np.int64)
            place[rare] = np.arange(len(rare))
            sequence = np.where(near, class_of[number], classes)[codes]
            ends = np.flatnonzero(codes[1:] == 0)
            first = np.r_[0, ends[:-1] + 1]
            inner = np.zeros((classes + 1, classes + 1))
            inner[:classes, :classes] = chance
            values = inner[sequence[:-1], sequence[1:]] + of(in_class)[codes[1:]]
            at = np.flatnonzero(~near[codes])
            heads = np.searchsorted(key % in_parts, np.arange(in_parts + 1))
            whole = {
                "n_tokens": np.diff(np.r_[-1, ends]),
                "n_known": np.add.reduceat(of(is_known.astype(np.int64))[codes[1:]], first),
                "base": np.add.reduceat(of(log_count)[codes[1:]], first),
                "score": np.add.reduceat(values, first),
                "spelled": packed(np.array([shape(words[k]) for k in rare.tolist()], np.int64)),
                "rare_n": packed(np.bincount(np.searchsorted(ends, at - 1), minlength=len(ends))),
                "rare": packed(place[codes[at]]),
                "before": packed(sequence[at - 1]),
                "after": packed(sequence[at + 1]),
            }
            asks = [{"part": p, "keys": key[heads[p] : heads[p + 1]].tobytes()} for p in np.flatnonzero(np.diff(heads)).tolist()]
            yield made([whole, *asks], chunk, *(pa.concat_arrays([b.column(c) for b in held]) for c in ("doc_id", "trained")))

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """What each chunk asked a part for: classes and counts, a count of zero where a word is unknown."""
        now, held, table = None, [], None
        for batch in batches:
            part, chunk, keys = (batch.column(c).to_pylist() for c in ("part", "chunk", "keys"))
            key, of_class, c = (batch.column(x) for x in ("key", "class", "c"))
            asks = np.flatnonzero(batch.column("chunk").is_valid().to_numpy(zero_copy_only=False)).tolist()
            start = 0
            for k in [*asks, batch.num_rows]:
                # The words of a part come before those who ask for them.
                for a, b in _runs(part, start, k):
                    if part[a] != now:
                        now, held, table = part[a], [], None
                    held.append([x.slice(a, b - a).to_numpy() for x in (key, of_class, c)])
                start = k + 1
                if k == batch.num_rows:
                    break
                if part[k] != now:
                    now, held, table = part[k], [], None
                if table is None:
                    table = [np.concatenate(x) for x in zip(*held, strict=True)] if held else [np.empty(0, np.int64)] * 3
                    held = []
                mine = np.frombuffer(keys[k], np.int64)
                at = np.minimum(np.searchsorted(table[0], mine), max(len(table[0]) - 1, 0))
                here = table[0][at] == mine if len(table[0]) else np.zeros(len(mine), bool)
                found = [packed(np.where(here, x[at], 0) if len(x) else np.zeros(len(mine), np.int64)) for x in table[1:]]
                arrays = [pa.array([chunk[k]], pa.int64()), pa.array([now], pa.int32()), *[pa.array([x], pa.binary()) for x in found]]
                yield pa.RecordBatch.from_arrays(arrays, names=["chunk", "part", "class", "c"])

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chance, _, _, _, _, unknown_class, left = local.value
        answers: list[list[np.ndarray]] = [[], []]
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1)
                if row.column("part")[0].is_valid:
                    for x, c in zip(answers, ("class", "c"), strict=True):
                        x.append(unpacked(row.column(c)[0].as_py()))
                    continue
                of_class, c = (np.concatenate([np.empty(0, np.int64), *x]) for x in answers)
                answers = [[], []]
                spelled, rare_n, rare, before, after = (unpacked(row.column(x)[0].as_py()) for x in blobs[:5])
                own = np.where(c > 0, of_class, unknown_class[spelled])
                inside = np.where(c > 0, np.log10(np.maximum(c - taken[own], 1e-9) / np.maximum(tokens_of[own], 1)), left[own])
                doc, mine = np.repeat(np.arange(len(rare_n)), rare_n), own[rare]
                before = np.where(before == classes, np.r_[0, mine[:-1]] if len(mine) else mine, before)
                values = inside[rare] + chance[before, mine]
                values += np.where(after == classes, 0.0, chance[mine, np.minimum(after, classes - 1)])
                more = [np.bincount(doc, x, len(rare_n)) for x in (np.zeros(len(doc)), (c > 0)[rare], np.log10(c + 1.0)[rare], values)]
                arrays = [row.column(x).flatten() for x in ("doc_id", "trained")]
                for x, y in zip(sums, more, strict=True):
                    old = row.column(x).flatten().to_numpy()
                    arrays.append(pa.array(old + y.astype(old.dtype)))
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "trained", *sums])

    begun = settle(rows.mapInArrow(begin, schema))
    asked = begun.where("part IS NOT NULL").select("part", "chunk", "keys", F.lit(None).cast("long").alias("key"), F.lit(None).cast("int").alias("class"), F.lit(None).cast("long").alias("c"))
    known_words = members.select(F.pmod("key", F.lit(in_parts)).cast("int").alias("part"), F.lit(None).cast("long").alias("chunk"), F.lit(None).cast("binary").alias("keys"), "key", "class", "c")
    looked_up = known_words.unionByName(asked).repartition("part").sortWithinPartitions("part", F.col("chunk").asc_nulls_first(), "key")
    answers = looked_up.mapInArrow(answer, "chunk long, part int, class binary, c binary")
    # A chunk comes after the answers to it, which come by their parts.
    mixed = begun.where("part IS NULL").drop("class", "c", "keys").unionByName(answers, allowMissingColumns=True)
    ordered = mixed.repartition("chunk").sortWithinPartitions("chunk", F.col("part").asc_nulls_last())
    scored = ordered.mapInArrow(finish, f"doc_id {kind}, trained boolean, n_tokens long, n_known long, base double, score double")
    size = float(np.log10(total + distinct + 1))
    return scored.select(
        "doc_id",
        "trained",
        "n_tokens",
        "n_known",
        F.lit(int(total)).cast("long").alias("train_tokens"),
        (F.col("base") - F.col("n_tokens") * size).alias("base_score"),
        "score",
    )

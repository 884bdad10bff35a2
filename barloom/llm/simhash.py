"""SimHash near-duplicates: exact, by tiles of fingerprints.

The distinct fingerprints are sorted by population count and cut into tiles. Two fingerprints
within the radius have population counts within the radius, so only pairs of tiles whose counts come that
near are compared: each pair is one exclusive-or and bit count over numpy blocks. Tiles are dealt in strips of some that follow each other, and a task
compares two strips: a tile travels once for each strip that its own comes near, not for each tile. A pair of tiles returns a spanning
forest of its links, so a group of any size gives no more links than it has fingerprints. The components
of the links are found by Spark (``components``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.common import broadcast_if_small
from barloom.llm.components import connected_components
from barloom.scratch import settle

#: Fingerprints of a tile, tiles of a strip at least, and strips at most: of more tiles the strips are longer, so that a tile travels so many times at most.
TILE, STRIP, STRIPS = 16384, 8, 512
#: Pairs compared at once.
BLOCK = 1 << 20


def fingerprint(text: str | None, shingle: int = 4, seed: int = 42) -> int:
    """The SimHash of a whole text's shingles of words, each with its repeats; 0 without words.

    ASCII is lower-cased; words are what stands between ASCII white space. Fewer words than a
    shingle has are one shingle.
    """
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends, at = [], -1
    for w in words:
        at += len(w) + 1
        ends.append(at)
    starts = [0, *[e + 1 for e in ends[:-1]]]
    hash64 = xxhash.xxh64_intdigest
    hashes = np.array([hash64(joined[s:e], seed) for s, e in zip(starts, ends[shingle - 1 :] or ends[-1:], strict=False)], "<u8")
    ones = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 4096):
        ones += np.unpackbits(hashes[k : k + 4096].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(documents: DataFrame, text_col: str, keep: list[str], shingle: int = 4, seed: int = 42) -> DataFrame:
    """The columns ``keep`` and ``fp``, the fingerprint as a signed long."""
    kept = documents.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text_col}`").alias("__text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(x, shingle, seed) for x in batch.column("__text").to_pylist()], np.uint64).view(np.int64)
            columns = [batch.column(k) for k in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found)], names=[*keep, "fp"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-1])
    return kept.mapInArrow(work, f"{schema}, fp long")


def links_between(a: np.ndarray, b: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links between two arrays of distinct fingerprints (the same array twice:
    within it): each linked fingerprint with one that stands for its group."""
    same = a is b
    nodes = a if same else np.concatenate((a, b))
    parent = np.arange(len(nodes))
    shift = 0 if same else len(a)
    rows = max(1, BLOCK // max(len(b), 1))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for first in range(0, len(a), rows):
        start = first + 1 if same else 0
        near = np.bitwise_count(a[first : first + rows, None] ^ b[None, start:]) <= radius
        for i in np.flatnonzero(near.any(axis=1)):
            others = np.flatnonzero(near[i]) + start + shift
            if same:
                others = others[others > first + i]
            if not len(others):
                continue
            # Flatten what is met, so that a large group costs a lookup for each of its members.
            tops = parent[others]
            while (parent[tops] != tops).any():
                tops = parent[tops]
            tops = np.unique(np.append(tops, root(first + int(i))))
            parent[tops] = tops[0]
            parent[others] = tops[0]
    while (parent[parent] != parent).any():
        parent = parent[parent]
    linked = np.flatnonzero(parent != np.arange(len(nodes)))
    return nodes[linked], nodes[parent[linked]]


def strip_links(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """The links of pairs of strips: rows ``s1``, ``s2``, ``side`` (0 or 1; a strip with itself has 0 only), ``lo``, ``hi``, ``fps``, sorted by the first three. Of a
    pair the tiles of side 0 are held, those of side 1 pass by."""
    now, held = None, []

    def links(a: tuple, b: tuple) -> Iterator[pa.RecordBatch]:
        if a[0] <= b[1] + radius and b[0] <= a[1] + radius:
            x, y = links_between(a[2], b[2], radius)
            if len(x):
                yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)), pa.array(y.view(np.int64))], names=["a", "b"])

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("s1", "s2", "side", "lo", "hi")]
        for s1, s2, side, lo, hi, fps in zip(*columns, batch.column("fps"), strict=True):
            if (s1, s2) != now:
                now, held = (s1, s2), []
            tile = (lo, hi, np.frombuffer(fps.as_py(), "<u8"))
            for other in held if side or s1 == s2 else ():
                yield from links(other, tile)
            if s1 == s2:
                yield from links(tile, tile)
            if side == 0:
                held.append(tile)


def fingerprint_links(distinct: DataFrame, radius: int = 4, tile: int = TILE, strip: int = STRIP) -> DataFrame:
    """Links ``a``, ``b`` that connect the distinct fingerprints of column ``fp`` as all pairs within
    ``radius`` bits do."""
    counted = distinct.select("fp", F.bit_count("fp").cast("int").alias("pop"))
    parts = max(1, -(-distinct.count() // tile))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = pa.table({"fp": pa.array([], pa.int64()), "pop": pa.array([], pa.int32())})

        def packed(part: pa.Table) -> pa.RecordBatch:
            pops, fps = part["pop"].to_numpy(), part["fp"].to_numpy()
            columns = {"lo": [int(pops.min())], "hi": [int(pops.max())], "fps": [fps.astype("<i8").tobytes()]}
            return pa.RecordBatch.from_pydict(columns, pa.schema([("lo", pa.int32()), ("hi", pa.int32()), ("fps", pa.binary())]))

        for batch in batches:
            rest = pa.concat_tables([rest, pa.Table.from_batches([batch])])
            while len(rest) >= tile:
                yield packed(rest.slice(0, tile))
                rest = rest.slice(tile)
        if len(rest):
            yield packed(rest)

    sorted_by_count = counted.repartitionByRange(parts, "pop", "fp").sortWithinPartitions("pop", "fp")
    # A fingerprint is in one tile only, so the tile's first one names it.
    tiles = settle(sorted_by_count.mapInArrow(pack, "lo int, hi int, fps binary").withColumn("tile", F.monotonically_increasing_id()))
    # Strips of tiles in their order; one small row for each tile goes through one task.
    strip = max(strip, -(-tiles.count() // STRIPS))
    number = F.row_number().over(Window.orderBy("lo", "hi", "tile"))
    strips = settle(tiles.select("tile", "lo", "hi").withColumn("strip", F.floor((number - 1) / strip).cast("int")))
    spans = strips.groupBy("strip").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    left = spans.select(F.col("strip").alias("s1"), F.explode(F.sequence("lo", "hi")).alias("pop"))
    right = spans.select(F.col("strip").alias("s2"), F.explode(F.sequence(F.col("lo") - radius, F.col("hi") + radius)).alias("pop"))
    pairs = settle(left.join(right, "pop").where("s1 <= s2").select("s1", "s2").distinct())
    in_strip = tiles.join(broadcast_if_small(strips.select("tile", "strip"), 32), "tile").select("strip", "lo", "hi", "fps")
    near = lambda side, name: in_strip.withColumnRenamed("strip", name).join(broadcast_if_small(pairs.where(f"{side} = 0 OR s1 <> s2"), 16), name).select("s1", "s2", F.lit(side).alias("side"), "lo", "hi", "fps")
    met = near(0, "s1").unionByName(near(1, "s2"))
    # A pair of strips to a task, as far as the numbers fall so.
    dealt = met.repartition(max(1, pairs.count()), "s1", "s2").sortWithinPartitions("s1", "s2", "side")
    return dealt.mapInArrow(lambda batches: strip_links(batches, radius), "a long, b long")


def simhash_components(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None, shingle: int = 4, radius: int = 4, seed: int = 42, tile: int = TILE
) -> DataFrame:
    """One row for each row of ``documents``: its id, the columns ``keep``, ``fp`` (the fingerprint, a signed long),
    ``root`` (a fingerprint that names the component) and ``component_id``, the smallest id among the rows that links of at
    most ``radius`` differing bits reach.

    Repeated rows and repeated ids stay rows of their own. Null and empty texts have fingerprint 0
    and link like any other. ``component_id`` passes over null ids, and is null if a component has no other.
    """
    rows = settle(fingerprints(documents, text_col, [id_col, *(keep or [])], shingle, seed))
    smallest = rows.groupBy("fp").agg(F.min(F.col(f"`{id_col}`")).alias("__least"))
    known = settle(smallest)
    roots = settle(connected_components(fingerprint_links(known.select("fp"), radius, tile)))
    member = known.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), "__least")
    named = member.groupBy("root").agg(F.min("__least").alias("component_id"))
    of_fp = member.join(named, "root").select("fp", "root", "component_id")
    return rows.join(of_fp, "fp")

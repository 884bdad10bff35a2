"""Approximate nearest neighbours by largest inner product: multiprobe p-stable hashing.

Vectors get one more component, so that all have the length of the longest and the largest inner product with a query is the smallest
distance from it. A table hashes a vector by several projections on normal directions, each cut into cells of one width; the cells are its
bucket. A query visits buckets in the order of the estimated chance that a neighbour lies there, given where the query itself
lies and how near its neighbours are (estimated on a bounded sample), until the chances of all tables reach ``success``.

Buckets whose first cells agree are one group, which meets the queries that visit any of them in one task. Groups with many vectors or many
visits are split, so a task holds a bounded number of both. Candidates are compared by exact inner products, and the
tables' best are merged.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.common import broadcast_if_small
from barloom.scratch import settle

#: Vectors, queries and visited buckets that meet in a task at most.
GROUP_VECTORS, GROUP_QUERIES, GROUP_VISITS = 16_384, 4096, 1 << 20
#: Inner products that a task holds at once.
PRODUCTS = 1 << 21
#: Vectors that a bucket has on average, and bits that a cell of width 2 tells about a standard normal value.
BUCKET_VECTORS, CELL_BITS = 256, 1.2
#: Cell numbers are kept modulo 16, of which 15 fit a long.
MOST_CELLS = 15


def usable(vector: Column) -> Column:
    """Whether a vector takes part: not null, no null or non-finite component, and one that isn't zero."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return F.coalesce(~F.exists(vector, bad) & F.exists(vector, lambda x: x != 0), F.lit(False))


class Hashing:
    """Tables of projections; the same for the same numbers in every task."""

    def __init__(self, tables: int, cells: int, prefix: int, width: float, unit: float, longest: float, seed: int) -> None:
        self.tables, self.cells, self.prefix, self.width, self.seed = tables, cells, prefix, width, seed
        #: Components are divided by ``unit``, so that no square overflows; ``longest`` is in these units.
        self.unit, self.longest = unit, longest

    def directions(self, dims: int) -> tuple[np.ndarray, np.ndarray]:
        rng = np.random.default_rng([self.seed, dims])
        return rng.normal(size=(self.tables, dims + 1, self.cells)), rng.uniform(0, self.width, size=(self.tables, self.cells))

    def _code(self, cells: np.ndarray) -> np.ndarray:
        code = np.zeros(cells.shape[:-1], np.int64)
        for j in range(cells.shape[-1]):
            code = code * 16 + (cells[..., j] & 15)
        return code

    def prefixes(self, codes: np.ndarray) -> np.ndarray:
        return codes >> (4 * (self.cells - self.prefix))

    def buckets(self, vectors: np.ndarray) -> np.ndarray:
        """The bucket of each vector in each table, as (tables, vectors)."""
        a, b = self.directions(vectors.shape[1])
        x = vectors / self.unit
        more = np.sqrt(np.maximum(self.longest**2 - (x**2).sum(axis=1), 0))
        places = np.concatenate((x, more[:, None]), axis=1) / self.longest @ a
        return self._code(np.floor((places + b[:, None]) / self.width).astype(np.int64))

    def visits(self, queries: np.ndarray, cosines: np.ndarray, success: float, most: int) -> list[list[np.ndarray]]:
        """For each table and query the buckets to visit, likeliest first, until their chances add up to the table's part of ``success``.

        ``cosines`` says how near a neighbour is to each query, between the lengthened vectors."""
        a, b = self.directions(queries.shape[1])
        x = queries / self.unit
        x /= np.sqrt((x**2).sum(axis=1))[:, None]
        part = 1 - (1 - success) ** (1 / self.tables)
        reach = math.ceil(5 / self.width)
        numbers = np.arange(-reach, reach + 1)
        spread = np.sqrt(1 - cosines**2)[:, None, None]
        found = []
        for t in range(self.tables):
            # A neighbour's place along a direction is normal about the query's, drawn in by the cosine.
            mean = (cosines[:, None] * (x @ a[t, :-1]))[:, :, None]
            low = (numbers * self.width - b[t][:, None])[None]
            chance = _normal((low + self.width - mean) / spread) - _normal((low - mean) / spread)
            total, code = np.ones((len(x), 1)), np.zeros((len(x), 1), np.int64)
            for j in range(self.cells):
                # The likeliest buckets start with the likeliest beginnings, so the rest can go at once.
                total = (total[:, :, None] * chance[:, j, None, :]).reshape(len(x), -1)
                code = (code[:, :, None] * 16 + (numbers & 15)).reshape(len(x), -1)
                if total.shape[1] > most:
                    kept = np.argpartition(-total, most, axis=1)[:, :most]
                    total, code = np.take_along_axis(total, kept, 1), np.take_along_axis(code, kept, 1)
            order = np.argsort(-total, axis=1, kind="stable")
            sums = np.cumsum(np.take_along_axis(total, order, 1), axis=1)
            code = np.take_along_axis(code, order, 1)
            ends = (sums < part).sum(axis=1) + 1
            found.append([np.unique(code[i, :n]) for i, n in enumerate(ends)])
        return found


def _normal(z: np.ndarray) -> np.ndarray:
    """The normal distribution, by Abramowitz and Stegun's 26.2.17 (error below 1e-7)."""
    t = 1 / (1 + 0.2316419 * np.abs(z))
    tail = np.exp(-z * z / 2) / math.sqrt(2 * math.pi) * t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    return np.where(z >= 0, 1 - tail, tail)


def exact_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the rows of two arrays, summed from the first component to the last."""
    total = np.zeros(len(a))
    for j in range(a.shape[1]):
        total += a[:, j] * b[:, j]
    return total


def _matrix(rows: list[bytes], kind: str) -> np.ndarray:
    """Rows of equal length from bytes, in double precision."""
    return np.frombuffer(b"".join(rows), kind).astype(np.float64).reshape(len(rows), -1)


def best_in_group(codes: np.ndarray, ids: list, vectors: np.ndarray, query_ids: list, queries: np.ndarray, visits: list[np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``k`` best of the visited vectors for each query, as numbers of queries and vectors and their products, best first. A query's own id is left out;
    a row repeated with its id counts once, and of products alike the smaller id comes first, a null one last."""
    known = np.array([x is not None for x in ids])
    number = np.array([x if x is not None else 0 for x in ids], np.int64)
    raw = np.ascontiguousarray(vectors + 0.0).view(np.dtype((np.void, vectors.shape[1] * 8))).ravel()
    _, same = np.unique(raw, return_inverse=True)
    order = np.lexsort((number, ~known, same, codes))
    # Of equal vectors (which lie in one bucket) only the k + 1 smallest ids can be among the best, the query's own counted.
    s, w, n = same[order], known[order], number[order]
    fresh = np.r_[True, (s[1:] != s[:-1]) | (w[1:] != w[:-1]) | (n[1:] != n[:-1])]
    order, s = order[fresh], s[fresh]
    starts = np.flatnonzero(np.r_[True, s[1:] != s[:-1]])
    place = np.arange(len(s)) - np.repeat(starts, np.diff(np.r_[starts, len(s)]))
    order = order[place <= k]
    codes, vectors, number, known = codes[order], vectors[order], number[order], known[order]
    names, first = np.unique(codes, return_index=True)
    last = np.r_[first[1:], len(codes)]
    asked = np.repeat(np.arange(len(queries)), [len(v) for v in visits])
    wanted = np.concatenate(visits) if visits else np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(names, wanted), len(names) - 1)
    there = names[at] == wanted
    asked, at = asked[there], at[there]
    by_bucket = np.argsort(at, kind="stable")
    asked, at = asked[by_bucket], at[by_bucket]
    own = np.array([x if x is not None else 0 for x in query_ids], np.int64)
    lengths = np.sqrt((queries**2).sum(axis=1))
    slack = 1e-9 * lengths * (np.sqrt((vectors**2).sum(axis=1)).max() if len(vectors) else 0)
    least = np.full(len(queries), -np.inf)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    cuts = np.flatnonzero(np.r_[True, at[1:] != at[:-1], True]) if len(at) else [0]
    for begin, end in zip(cuts[:-1], cuts[1:], strict=True):
        lo, hi = first[at[begin]], last[at[begin]]
        rows = max(1, PRODUCTS // (hi - lo))
        for cut in range(begin, end, rows):
            who = asked[cut : min(cut + rows, end)]
            products = queries[who] @ vectors[lo:hi].T
            products[known[lo:hi][None, :] & (number[lo:hi][None, :] == own[who, None])] = -np.inf
            if hi - lo >= k:
                least[who] = np.maximum(least[who], np.partition(products, hi - lo - k, axis=1)[:, hi - lo - k])
            q, v = np.nonzero((products >= (least[who] - slack[who])[:, None]) & (products > -np.inf))
            found.append((who[q], v + lo))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    q, v = (np.concatenate(x) for x in zip(*found, strict=True))
    score = exact_products(queries[q], vectors[v])
    ranked = np.lexsort((number[v], ~known[v], -score, q))
    q, v, score = q[ranked], v[ranked], score[ranked]
    starts = np.flatnonzero(np.r_[True, q[1:] != q[:-1]]) if len(q) else np.zeros(0, np.int64)
    place = np.arange(len(q)) - np.repeat(starts, np.diff(np.r_[starts, len(q)]))
    keep = place < k
    return q[keep], order[v[keep]], score[keep]


def nearest_neighbours(
    vectors: DataFrame,
    is_query: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = 20,
    tables: int = 4,
    width: float = 2.0,
    success: float = 0.93,
    sample: int = 4096,
    visits: int = 4096,
    seed: int = 11,
) -> DataFrame:
    """For each row where ``is_query`` holds, the ``k`` rows with the largest inner products that its visits find (all, if there are fewer): ``query_id``,
    ``rank`` from 1, ``vec_id`` and ``score``, the inner product in double precision. Of equal scores the smaller id comes first, a null id last.

    ``success`` is the chance aimed at that a neighbour's bucket is visited in any table; ``sample`` bounds the rows on which a query's nearness to its
    neighbours is estimated, and ``visits`` the buckets that a query visits in a table. Every row is indexed.

    Vectors that are null, zero or hold a null or non-finite component take no part. Vectors of different lengths have no inner product and are
    no neighbours. Rows with the query's id are its own; a row repeated with its id and vector counts once, and rows of one id with different vectors are
    rows of their own (a query id then has a ranking for each). Products beyond the range of doubles are infinite and rank by their true size. A null id is a candidate and never a query. An empty table has no rows.
    """
    spark = vectors.sparkSession
    column = F.col(f"`{vector_col}`")
    single = vectors.schema[vector_col].dataType.elementType.simpleString() == "float"
    kind, kept_as = ("<f4", "float") if single else ("<f8", "double")
    rows = settle(vectors.where(usable(column)).select(F.col(f"`{id_col}`").cast("long").alias("id"), column.cast(f"array<{kept_as}>").alias("v"), F.coalesce(is_query & F.col(f"`{id_col}`").isNotNull(), F.lit(False)).alias("asks")))
    out = "query_id long, rank int, vec_id long, score double"
    size = lambda x: F.abs(x.cast("double"))
    count, largest = rows.agg(F.count("*"), F.max(F.array_max(F.transform("v", size)))).first()
    if not count:
        return spark.createDataFrame([], out)
    # A power of two, so that dividing by it changes no digit.
    unit = math.ldexp(1.0, math.frexp(largest)[1])
    squares = F.aggregate(F.transform("v", lambda x: (x.cast("double") / F.lit(unit)) ** 2), F.lit(0.0), lambda s, x: s + x)
    longest = math.sqrt(rows.agg(F.max(squares)).first()[0])
    bits = lambda part: max(0, round(math.log2(max(1.0, count / part)) / CELL_BITS))
    cells = min(MOST_CELLS, max(2, bits(BUCKET_VECTORS)))
    hashing = Hashing(tables, cells, min(cells, bits(GROUP_VECTORS)), width, unit, longest, seed)
    drawn = rows.select("v", F.xxhash64(F.monotonically_increasing_id()).alias("o")).orderBy("o").limit(sample).toArrow()["v"].to_pylist()
    by_length: dict[int, np.ndarray] = {n: np.array([v for v in drawn if len(v) == n], np.float64) / unit for n in {len(v) for v in drawn}}
    #: The place among the sample's neighbours that stands for the last of the k among all rows.
    nth = math.ceil(k * min(1.0, len(drawn) / count))
    known = spark.sparkContext.broadcast(by_length)

    def of_lengths(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
        """A batch by the lengths of its vectors."""
        lengths = np.array([len(x) for x in batch.column("v")], np.int64)
        for n in np.unique(lengths):
            yield int(n), batch.take(pa.array(np.flatnonzero(lengths == n)))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for dims, batch in of_lengths(whole):
                flat = batch.column("v").flatten().to_numpy().reshape(-1, dims)
                kept = pa.array([r.tobytes() for r in flat.astype(kind)], pa.binary())
                for t, codes in enumerate(hashing.buckets(flat.astype(np.float64))):
                    n = len(codes)
                    made = [pa.array(np.full(n, t, np.int32)), pa.array(np.full(n, dims, np.int32)), pa.array(hashing.prefixes(codes)), pa.array(codes), batch.column("id"), kept]
                    yield pa.RecordBatch.from_arrays(made, names=["t", "dims", "prefix", "code", "id", "v"])

    def nearness(x: np.ndarray) -> np.ndarray:
        """How near the last of a query's neighbours is, as a cosine between lengthened vectors; 0 without a sample."""
        drawn_here = known.value.get(x.shape[1])
        if drawn_here is None or len(drawn_here) < 2:
            return np.zeros(len(x))
        x = x / unit
        products = x @ drawn_here.T / np.sqrt((x**2).sum(axis=1))[:, None] / longest
        # The query itself may be in the sample.
        place = min(nth + 1, len(drawn_here))
        return np.clip(np.partition(products, len(drawn_here) - place, axis=1)[:, len(drawn_here) - place], -0.99, 0.99)

    def visited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for dims, batch in of_lengths(whole):
                for start in range(0, batch.num_rows, 64):
                    part = batch.slice(start, 64)
                    flat = np.array(part.column("v").to_pylist(), kind)
                    x = flat.astype(np.float64)
                    made: list[tuple] = []
                    for t, of_queries in enumerate(hashing.visits(x, nearness(x), success, visits)):
                        for i, codes in enumerate(of_queries):
                            heads = hashing.prefixes(codes)
                            for head in np.unique(heads):
                                made.append((t, dims, int(head), part.column("id")[i].as_py(), part.column("q")[i].as_py(), flat[i].tobytes(), codes[heads == head]))
                    columns = list(zip(*made, strict=True))
                    types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64())]
                    yield pa.RecordBatch.from_arrays([pa.array(c, type=y) for c, y in zip(columns, types, strict=True)], names=["t", "dims", "prefix", "id", "q", "v", "codes"])

    index = settle(rows.select("id", "v").mapInArrow(hashed, "t int, dims int, prefix long, code long, id long, v binary").withColumn("part", F.monotonically_increasing_id()))
    # Rows repeated with their id ask once; the hash tells apart vectors of one id.
    asking = settle(rows.where("asks").select("id", "v").distinct().withColumn("q", F.xxhash64("v")))
    probes = settle(asking.mapInArrow(visited, "t int, dims int, prefix long, id long, q long, v binary, codes array<long>"))
    known.destroy()
    ranked = settle(_ranked(_compared(index, probes, k, kind, unit), k))
    full = ranked.where(F.col("rank") == k).select("id", "q")
    short = asking.join(full, ["id", "q"], "left_anti")
    if short.limit(1).count():
        # Queries whose buckets hold fewer rows than asked for are compared with all rows of their length.
        first = index.where("t = 0").withColumns({"t": F.lit(-1), "prefix": F.lit(0).cast("long"), "code": F.lit(0).cast("long")})
        as_bytes = probes.select("id", "q", "dims", "v").join(short.select("id", "q"), ["id", "q"], "left_semi").distinct()
        everywhere = as_bytes.select(F.lit(-1).alias("t"), "dims", F.lit(0).cast("long").alias("prefix"), "id", "q", "v", F.array(F.lit(0).cast("long")).alias("codes"))
        whole = _ranked(_compared(first, settle(everywhere), k, kind, unit), k)
        ranked = ranked.join(short.select("id", "q"), ["id", "q"], "left_anti").unionByName(whole)
    return ranked.select(F.col("id").alias("query_id"), "rank", "vec_id", (F.col("score") * F.lit(unit) * F.lit(unit)).alias("score"))


def _compared(index: DataFrame, probes: DataFrame, k: int, kind: str, unit: float) -> DataFrame:
    """The best of each split of a group for each query that visits it: ``id``, ``q`` and the list ``found``, best first, with products of
    the vectors divided by ``unit``."""
    keys = ["t", "dims", "prefix"]
    held = index.groupBy(*keys).agg(F.ceil(F.count("*") / GROUP_VECTORS).cast("int").alias("vs"))
    asked = probes.groupBy(*keys).agg(F.ceil(F.greatest(F.count("*") / GROUP_QUERIES, F.sum(F.size("codes")) / GROUP_VISITS)).cast("int").alias("qs"))
    groups = broadcast_if_small(settle(held.join(asked, keys)), 32)
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    dealt = index.join(groups, keys).select(*keys, "code", "id", "v", F.pmod(F.xxhash64("part"), "vs").cast("int").alias("vp"), every("qs").alias("qp"))
    called = probes.join(groups, keys).select(*keys, "id", "q", "v", "codes", every("vs").alias("vp"), F.pmod(F.xxhash64("id", "q"), "qs").cast("int").alias("qp"))

    def compare(vectors: pa.Table, asking: pa.Table) -> pa.Table:
        schema = pa.schema([("id", pa.int64()), ("q", pa.int64()), ("found", pa.list_(pa.struct([("score", pa.float64()), ("vec_id", pa.int64()), ("w", pa.int64())])))])
        if not vectors.num_rows or not asking.num_rows:
            return schema.empty_table()
        ids, asks, hashes = (x.to_pylist() for x in (vectors["id"], asking["id"], asking["q"]))
        kept = vectors["v"].to_pylist()
        visits = [np.array(x, np.int64) for x in asking["codes"].to_pylist()]
        q, v, score = best_in_group(vectors["code"].to_numpy(), ids, _matrix(kept, kind) / unit, asks, _matrix(asking["v"].to_pylist(), kind) / unit, visits, k)
        lists: dict[int, list[dict]] = {}
        for i, j, x in zip(q.tolist(), v.tolist(), score.tolist(), strict=True):
            lists.setdefault(i, []).append({"score": x, "vec_id": ids[j], "w": xxhash.xxh64_intdigest(kept[j]) - (1 << 63)})
        return pa.Table.from_pylist([{"id": asks[i], "q": hashes[i], "found": x} for i, x in lists.items()], schema)

    by = [*keys, "vp", "qp"]
    return dealt.groupBy(*by).cogroup(called.groupBy(*by)).applyInArrow(compare, "id long, q long, found array<struct<score:double,vec_id:long,w:long>>")


def _ranked(lists: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of all lists of a query: ``id``, ``q``, ``rank``, ``vec_id``, ``score``."""
    # A list that is full bounds the query's last place from below, so little of the others has to be merged.
    query = Window.partitionBy("id", "q")
    last = F.when(F.size("found") == k, F.get("found", F.lit(k - 1))["score"])
    bounded = lists.withColumn("least", F.max(last).over(query))
    near = bounded.select("id", "q", F.explode(F.filter("found", lambda x: F.col("least").isNull() | (x["score"] >= F.col("least")))).alias("f"))
    merged = near.groupBy("id", "q", F.col("f.vec_id").alias("vec_id"), F.col("f.w").alias("w")).agg(F.max("f.score").alias("score"))
    order = query.orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last(), "w")
    ranked = merged.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k)
    return ranked.select("id", "q", "rank", "vec_id", "score")

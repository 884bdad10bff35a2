"""Mixing sources to target weights by entropy balancing.

Each document gets a rate between 0 and ``cap``. Of all rates whose tokens meet the source's target,
those with the least relative entropy to one copy each are exponentially tilted:
``rate = min(cap, exp(tilt * size / mean size))``. The tilt of each source solves the convex
dual; Newton steps, kept within a bracket, run for all sources at once over the histogram of sizes.
Rates are then rounded to copies by systematic rounding along (source, size): along any stretch of a source the sums of
rates and of copies differ by less than one copy. Of ``STARTS`` starting points each source takes the one whose tokens
come nearest to its target.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import broadcast_if_small
from barloom.llm.ordering import running_before
from barloom.scratch import settle

#: Rates are whole numbers of this part of a copy, so that sums don't depend on their order.
UNIT = 1_000_000
#: Starting points of the rounding that are tried.
STARTS = 32
_SOURCE_BYTES = 256


def source_targets(sources: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """``sources`` (``source``, ``source_size``) with ``weight`` and ``target``.

    Sources by code point, null last, have the weights in turn and share ``share`` times all sizes by weight; none gets
    more than ``cap`` times its size, and what that leaves is shared again among the others.
    """
    ranked = running_before(sources.withColumn("one", F.lit(1).cast("long")), ["source"], "one", "rank").drop("one")
    turn = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    weighted = settle(ranked.withColumn("weight", turn).withColumn("most", F.col("source_size") * cap).drop("rank"))
    total = share * (weighted.agg(F.sum("source_size")).first()[0] or 0)
    level = 0.0
    while True:
        full = F.col("weight") * level > F.col("most")
        # Sums of halves and wholes: exact, in whatever order.
        kept, open_weight = weighted.agg(
            F.sum(F.when(full, F.col("most")).cast("decimal(38,6)")), F.sum(F.when(~full, F.col("weight")).cast("decimal(38,6)"))
        ).first()
        if not open_weight:
            break
        above = (total - float(kept or 0)) / float(open_weight)
        if above <= level:
            break
        level = above
    return weighted.withColumn("target", F.least(F.col("most"), F.col("weight") * level)).drop("most")


def tilts(histogram: DataFrame, targets: DataFrame, cap: float = 2.0, rounds: int = 60, tolerance: float = 1e-7) -> DataFrame:
    """``targets`` with ``tilt``, by source. ``histogram``: ``source``, ``size``, ``n`` documents.

    A source whose target is ``cap`` times its size, or is 0, has no finite tilt; its rates are ``cap`` or 0.
    """
    counts = histogram.groupBy("source").agg(F.sum("n").alias("docs"))
    state = settle(
        targets.join(counts.withColumnRenamed("source", "s2"), F.col("source").eqNullSafe(F.col("s2")))
        .drop("s2")
        .withColumn("mean", F.col("source_size") / F.col("docs"))
        .withColumn("open", (F.col("target") > 0) & (F.col("target") < F.col("source_size") * cap))
        .selectExpr("*", "0D AS tilt", "CAST(NULL AS DOUBLE) AS low", "CAST(NULL AS DOUBLE) AS high", "NOT open AS done")
    )
    for _ in range(rounds):
        if not state.where("not done").limit(1).count():
            break
        now = broadcast_if_small(state.where("not done").select(F.col("source").alias("s2"), "tilt", "mean"), _SOURCE_BYTES)
        joined = histogram.join(now, F.col("source").eqNullSafe(F.col("s2"))).where("size > 0")
        power = F.col("tilt") * F.col("size") / F.col("mean")
        free = F.exp(power) < cap
        tokens = F.col("n") * F.col("size") * F.when(free, F.exp(power)).otherwise(cap)
        slope = F.when(free, F.col("n") * F.col("size") * F.col("size") / F.col("mean") * F.exp(power)).otherwise(0.0)
        sums = joined.groupBy("s2").agg(F.sum(tokens.cast("decimal(32,9)")).cast("double").alias("got"), F.sum(slope.cast("decimal(32,9)")).cast("double").alias("slope"))
        moved = state.join(sums, F.col("source").eqNullSafe(F.col("s2")), "left").drop("s2")
        low = F.when(F.col("got") < F.col("target"), F.col("tilt")).otherwise(F.col("low"))
        high = F.when(F.col("got") >= F.col("target"), F.col("tilt")).otherwise(F.col("high"))
        newton = F.when(F.col("slope") > 0, F.col("tilt") + (F.col("target") - F.col("got")) / F.col("slope"))
        middle = F.when(low.isNull(), high - 2 * F.abs(high) - 1).when(high.isNull(), low + 2 * F.abs(low) + 1).otherwise((low + high) / 2)
        inside = newton.isNotNull() & (low.isNull() | (newton > low)) & (high.isNull() | (newton < high))
        near = F.abs(F.col("got") - F.col("target")) <= F.col("target") * tolerance
        state = settle(
            moved.select(
                *[c for c in state.columns if c not in ("tilt", "low", "high", "done")],
                F.when(F.col("done") | near, F.col("tilt")).when(inside, newton).otherwise(middle).alias("tilt"),
                F.when(F.col("done"), F.col("low")).otherwise(low).alias("low"),
                F.when(F.col("done"), F.col("high")).otherwise(high).alias("high"),
                (F.col("done") | F.coalesce(near, F.lit(True))).alias("done"),
            )
        )
    return state.select("source", "source_size", "weight", "target", "tilt", "mean", "open")


def mix(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", keep: list[str] | None = None, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, cap: float = 2.0
) -> DataFrame:
    """One row for each row of ``documents``: its id, the columns ``keep``, ``size``, ``source_size``, ``target``, ``rate``,
    ``copies`` and ``taken`` (copies times size).

    Null texts have size 0; null sources are one source. Repeated rows are documents of their
    own. The same rows give the same copies, whatever their partitions.
    """
    words = F.regexp_count(F.coalesce(F.col(f"`{text_col}`"), F.lit("")), F.lit("[^\\x20\\x09-\\x0D]+"))
    kept = [F.col(f"`{c}`") for c in (keep or [])]
    rows = settle(documents.select(F.col(f"`{id_col}`").alias("__id"), *kept, F.col(f"`{source_col}`").alias("source"), words.cast("long").alias("size")))
    histogram = settle(rows.groupBy("source", "size").agg(F.count("*").alias("n")))
    sources = histogram.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"))
    solved = settle(tilts(histogram, source_targets(settle(sources), weights, share, cap), cap))
    of_source = broadcast_if_small(solved.withColumnRenamed("source", "s2"), _SOURCE_BYTES)
    tilted = F.least(F.lit(cap), F.exp(F.col("tilt") * F.col("size") / F.col("mean")))
    rate = F.when(F.col("open"), tilted).when(F.col("target") > 0, F.lit(cap)).when(F.col("size") > 0, 0.0).otherwise(1.0)
    rated = rows.join(of_source, F.col("source").eqNullSafe(F.col("s2")))
    rated = rated.withColumn("units", F.round(rate * UNIT).cast("long")).withColumn("__down", -F.col("size")).withColumn("__hash", F.xxhash64("__id"))
    rated = rated.drop("s2", "tilt", "mean", "open", "weight")
    placed = settle(running_before(rated, ["source", "__down", "__hash", "__id", *(keep or [])], "units", "before"))

    def copies(start: Column) -> Column:
        return F.floor((F.col("before") + F.col("units") + start) / UNIT) - F.floor((F.col("before") + start) / UNIT)

    starts = F.explode(F.array(*[F.lit(UNIT * k // STARTS) for k in range(STARTS)]))
    sums = placed.withColumn("start", starts).groupBy("source", "start").agg(F.sum(copies(F.col("start")) * F.col("size")).alias("got"), F.first("target").alias("t"))
    nearest = sums.groupBy(F.col("source").alias("s2")).agg(F.min(F.struct(F.abs(F.col("got") - F.col("t")).alias("error"), "start"))["start"].alias("start"))
    best = broadcast_if_small(nearest, _SOURCE_BYTES)
    chosen = placed.join(best, F.col("source").eqNullSafe(F.col("s2"))).withColumn("copies", copies(F.col("start")))
    return chosen.select(
        F.col("__id").alias(id_col),
        *kept,
        "size",
        "source_size",
        "target",
        (F.col("units") / UNIT).alias("rate"),
        "copies",
        (F.col("copies") * F.col("size")).alias("taken"),
    )

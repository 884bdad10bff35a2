"""What becomes of every raw row: kept, dropped by a rule, collapsed into a copy, or astray.

The account is a by-product of cleaning. One scan of the raw rows, reduced on the map side, gives the rows that break
each rule, the spans in which bars may repeat, and a digest of each partition; the copies are counted by the
aggregate that collapses them, over the rows of those spans only. Kept rows are counted where they are kept, so
that the account is no identity and can be checked against the layers.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.functions.rules import drop_reason
from barloom.operators.clean import dedup_rows
from barloom.operators.repeats import span_counts, split_at
from barloom.scratch import settle
from barloom.sources.digests import DIGEST_COLUMNS, digest_aggs
from barloom.sources.layers import at_partitions
from barloom.spec import BarSpec

KEPT, COPY, STRAY = "kept", "copy", "stray"


@dataclass(frozen=True)
class Accounted:
    """Cleaned bars; ``account`` has ``rows`` for each (key, month, ``outcome``), ``digest`` a digest of the raw rows of each (key, month)."""

    bars: DataFrame
    account: DataFrame
    digest: DataFrame


def _partition(df: DataFrame, spec: BarSpec) -> list[str]:
    return [spec.month] if spec.month in df.columns else []


def _outcomes(rows: DataFrame, at: list[str], outcome: Column, count: Column) -> DataFrame:
    return rows.groupBy(*at, outcome.alias("outcome")).agg(F.sum(count).cast("long").alias("rows"))


def clean_with_account(
    raw: DataFrame, spec: BarSpec = BarSpec(), reject_nan: bool = True, dedup_first: bool = False
) -> Accounted:
    """The rows of ``clean_bars(few_repeated=True)`` with their account. Runs jobs for the spans and for the rows that may repeat.

    Per key and month the outcomes ``kept``, ``copy`` and the broken rules (the first that a row breaks) add up to
    the raw rows. With ``dedup_first`` copies are counted before the rules.
    """
    at = [spec.key, *_partition(raw, spec)]
    broken = drop_reason(spec, reject_nan)
    counts = settle(span_counts(raw, spec, F.lit(None).cast("string") if dedup_first else broken, at[1:], digest_aggs(raw, at)))
    spans = settle(counts.where("suspect").select(spec.key, "__span").distinct())
    usable = raw if dedup_first else raw.where(broken.isNull())
    repeated, single = split_at(usable, spans, spec)
    deduped = settle(dedup_rows(repeated, [spec.key, spec.time], copies="__copies"))
    bars = deduped.drop("__copies")
    bars = bars if single is None else single.unionByName(bars)
    copies = _outcomes(deduped, at, F.lit(COPY), F.col("__copies"))
    if dedup_first:
        marked = bars.withColumn("__reason", broken)
        ruled = _outcomes(marked, at, F.coalesce("__reason", F.lit(KEPT)), F.lit(1))
        bars = bars.where(broken.isNull())
    else:
        # Rows outside the listed spans go through as they are; those within are counted as they come out.
        rules = counts.where(F.col("reason").isNotNull())
        ruled = _outcomes(rules, at, F.col("reason"), F.col("__rows_of")).unionByName(_outcomes(deduped, at, F.lit(KEPT), F.lit(1)))
        if single is not None:
            through = at_partitions(counts.where(F.col("reason").isNull()), spans, [spec.key, "__span"], inside=False)
            ruled = ruled.unionByName(_outcomes(through, at, F.lit(KEPT), F.col("__rows_of")))
    account = ruled.unionByName(copies).groupBy(*at, "outcome").agg(F.sum("rows").alias("rows")).where("rows > 0")
    digest = counts.groupBy(*at).agg(F.sum("rows").alias("rows"), *[F.sum(c).alias(c) for c in DIGEST_COLUMNS])
    return Accounted(bars, account, digest)


def with_strays(account: DataFrame, strays: DataFrame | None, spec: BarSpec = BarSpec(), month: str = "file_month") -> DataFrame:
    """The account with the rows that an ingest set apart, in their file's month."""
    if strays is None:
        return account
    apart = strays.groupBy(spec.key, F.col(month).alias(spec.month)).agg(F.count("*").alias("rows"))
    return account.unionByName(apart.withColumn("outcome", F.lit(STRAY)))


def drop_accounting(account: DataFrame, raw: DataFrame, refined: DataFrame, spec: BarSpec = BarSpec(), strays: DataFrame | None = None) -> DataFrame:
    """The account of each key against the layers: a row for each (key, ``outcome``) but ``kept`` with its ``rows``, beside ``raw_rows`` (with the
    strays), ``refined_rows``, ``dropped_rows``, and ``unexplained_rows``: those the account doesn't explain, 0 where it adds up.

    A key from which nothing was dropped has one row with a null outcome. Both layers are counted by their files' footers.
    """
    key = spec.key

    def sized(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(key).agg(F.count("*").alias(name))

    tables = [sized(raw, "raw_rows"), sized(refined, "refined_rows")]
    if strays is not None:
        tables.append(sized(strays, "raw_rows"))
    layers = tables[0]
    for t in tables[1:]:
        layers = layers.unionByName(t, allowMissingColumns=True)
    dropped = account.groupBy(key, "outcome").agg(F.sum("rows").alias("rows")).where(F.col("outcome") != KEPT)
    # One aggregate in place of joins: keys may be null, and a key may be in any of the tables only.
    rows = layers.unionByName(dropped.withColumn("drop", F.struct("outcome", "rows")).select(key, "drop"), allowMissingColumns=True)
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c)
    of_key = rows.groupBy(key).agg(total("raw_rows"), total("refined_rows"), F.array_sort(F.collect_list("drop")).alias("drops"))
    of_key = of_key.withColumn("dropped_rows", F.col("raw_rows") - F.col("refined_rows"))
    explained = F.aggregate("drops", F.lit(0).cast("long"), lambda s, d: s + d["rows"])
    of_key = of_key.withColumn("unexplained_rows", F.col("dropped_rows") - explained)
    return of_key.select("*", F.explode_outer("drops").alias("drop")).select(
        key, F.col("drop.outcome").alias("outcome"), F.coalesce("drop.rows", F.lit(0).cast("long")).alias("rows"), "raw_rows", "refined_rows", "dropped_rows", "unexplained_rows"
    )

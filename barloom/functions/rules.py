"""Row predicates on bars."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from barloom.spec import BarSpec


def _number_rules(spec: BarSpec) -> list[tuple[str, Column]]:
    c = F.col
    return [
        ("open<=0", c(spec.open) > 0),
        ("close<=0", c(spec.close) > 0),
        ("low<=0", c(spec.low) > 0),
        ("high<low", c(spec.high) >= c(spec.low)),
        ("volume<0", c(spec.volume) >= 0),
    ]


def _infinite(name: str) -> Column:
    return F.abs(F.col(name).cast("double")) == float("inf")


def _finite_rules(spec: BarSpec) -> list[tuple[str, Column]]:
    prices = [spec.open, spec.high, spec.low, spec.close, spec.volume]
    return [(f"nan {p}", ~F.isnan(p)) for p in prices] + [(f"infinite {p}", ~_infinite(p)) for p in prices]


def _named(spec: BarSpec) -> Column:
    """An empty key would come back from a partitioned layer as null."""
    return F.col(spec.key).cast("string") != ""


def valid_bar(spec: BarSpec, reject_nan: bool = True) -> Column:
    """True for a usable bar: key fields present, key not empty, prices above zero, high not below low.

    Spark orders NaN above every number, so comparisons alone let it pass, and infinite prices too;
    ``reject_nan=False`` keeps that behaviour.
    """
    rules = [F.col(f).isNotNull() for f in spec.key_fields] + [_named(spec)]
    rules += [rule for _, rule in _number_rules(spec)]
    if reject_nan:
        rules += [rule for _, rule in _finite_rules(spec)]
    return reduce(and_, rules)


def drop_reason(spec: BarSpec, reject_nan: bool = True) -> Column:
    """The first rule of ``valid_bar`` that a row breaks; null for a usable bar."""
    broken = [(f"null {f}", F.col(f).isNull()) for f in spec.key_fields]
    broken += [(f"empty {spec.key}", ~_named(spec))]
    broken += [(name, ~rule) for name, rule in _number_rules(spec)]
    if reject_nan:
        broken += [(name, ~rule) for name, rule in _finite_rules(spec)]
    return F.coalesce(*[F.when(hit, F.lit(name)) for name, hit in broken])


def invalid_price(spec: BarSpec, columns: list[str], reject_nan: bool = True) -> Column:
    """True for a price that cannot be: zero or below, high below low, and as in ``valid_bar`` NaN or
    infinite. ``open`` and ``low`` count where the table has them, and so does a volume that is no number."""
    prices = [p for p in (spec.close, spec.high, spec.open, spec.low) if p in columns]
    hits = [F.col(p) <= 0 for p in prices if p != spec.high]
    if spec.low in columns:
        hits.append(F.col(spec.high) < F.col(spec.low))
    if reject_nan:
        numbers = prices + [spec.volume] * (spec.volume in columns)
        hits += [F.isnan(p) for p in numbers] + [_infinite(p) for p in numbers]
    return reduce(or_, [F.coalesce(hit, F.lit(False)) for hit in hits])

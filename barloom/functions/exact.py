"""Sums of doubles that do not depend on the order of their terms.

A double is a whole number times a power of two. Between the smallest and the largest exponent of the terms it is cut into
limbs of 30 bits, each a long; limbs add up exactly in any order and over any parts, and the total is rounded
once, to the nearest double (ties to even). A limb's sum fits a long for up to 2**33 terms; beyond, Spark's sum of longs raises.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 30
_MASK = (1 << BITS) - 1
# Fixed value: the exponent of the smallest bit that a double has.
_LOWEST = -1074


def _finite(x: Column) -> Column:
    return F.coalesce(~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False))


@dataclass(frozen=True)
class ExactSum:
    """How the terms of one sum are cut: ``limbs`` limbs, the lowest in units of 2**``low``.

    ``terms`` gives the columns to add up for a term, ``total`` the double from their sums. NaN and infinite terms
    add up beside the limbs, as doubles do; nulls do not count, and a sum over nulls only is null.
    """

    name: str
    low: int
    limbs: int

    @property
    def columns(self) -> list[str]:
        return [f"{self.name}_{k}" for k in range(self.limbs)] + [f"{self.name}_odd"]

    def terms(self, x: Column) -> dict[str, Column]:
        """A column for each limb, lowest first, and one for what is no number."""
        number = F.when(_finite(x), x.cast("double")).otherwise(F.when(x.isNotNull(), F.lit(0.0)))
        out = []
        for k in range(self.limbs):
            low, high = self.low + BITS * k, self.low + BITS * (k + 1)
            # A remainder by a power of two and a division by one are both exact.
            rest = number if k == self.limbs - 1 else number % F.lit(math.ldexp(1.0, high))
            out.append((rest / F.lit(math.ldexp(1.0, low))).cast("long"))
        odd = F.when(_finite(x), F.lit(0.0)).otherwise(x.cast("double"))
        return dict(zip(self.columns, [*out, odd], strict=True))

    def total(self, df: DataFrame, sums: dict[str, Column], name: str) -> DataFrame:
        """``df`` with the column ``name``: the sum as a double, from the sums of the limbs."""
        own = f"__{self.name}_"
        limbs = [f"{own}s{k}" for k in range(self.limbs)]
        columns = {limbs[k]: sums[self.columns[k]] for k in range(self.limbs)}
        out = df.withColumns(columns | {f"{own}odd": sums[self.columns[-1]]})
        # The sign is that of the highest carry; the digits are those of the absolute value. One step at a time, so that no expression
        # is written out twice.
        made = [*limbs, f"{own}odd"]
        carry: Column = F.lit(0).cast("long")
        for k, limb in enumerate(limbs):
            out = out.withColumn(f"{own}c{k}", F.shiftright(F.col(limb) + carry, BITS))
            made.append(f"{own}c{k}")
            carry = F.col(f"{own}c{k}")
        sign = f"{own}sign"
        out = out.withColumn(sign, F.when(carry < 0, F.lit(-1)).otherwise(F.lit(1)).cast("long"))
        made.append(sign)
        digits = []
        carry = F.lit(0).cast("long")
        for k in range(self.limbs + 2):
            value = (F.col(sign) * F.col(limbs[k]) if k < self.limbs else F.lit(0).cast("long")) + carry
            out = out.withColumn(f"{own}t{k}", value).withColumns({f"{own}d{k}": F.col(f"{own}t{k}").bitwiseAND(F.lit(_MASK)), f"{own}u{k}": F.shiftright(f"{own}t{k}", BITS)})
            made += [f"{own}t{k}", f"{own}d{k}", f"{own}u{k}"]
            carry = F.col(f"{own}u{k}")
            digits.append(F.col(f"{own}d{k}"))
        rounded = reduce(lambda so_far, k: F.when(digits[k] != 0, self._rounded(digits, k)).otherwise(so_far), range(len(digits)), F.lit(0.0))
        odd = F.col(f"{own}odd")
        value = F.when(odd.isNull(), F.lit(None).cast("double")).when(odd == 0, rounded * F.col(sign).cast("double")).otherwise(odd)
        return out.withColumn(name, value).drop(*made)

    def _rounded(self, digits: list[Column], top: int) -> Column:
        """The double nearest to the number whose highest digit that is not 0 is ``top``."""
        below = lambda k: digits[k] if k >= 0 else F.lit(0).cast("long")
        width = F.length(F.bin(digits[top]))
        left = F.lit(31) - width
        # 61 bits of the number, the last of them set if any bit below is; a cast then rounds as the whole number would.
        head = F.shiftleft(digits[top], BITS).bitwiseOR(below(top - 1))
        kept = _shift(head, left).bitwiseOR(_shift_right(below(top - 2), F.lit(BITS) - left))
        lost = below(top - 2).bitwiseAND(_shift(F.lit(1).cast("long"), F.lit(BITS) - left) - 1)
        rest = reduce(lambda a, b: a.bitwiseOR(b), [lost, *digits[: max(0, top - 2)]])
        sticky = F.when(rest != 0, kept.bitwiseOR(F.lit(1).cast("long"))).otherwise(kept)
        exponent = F.lit(self.low + BITS * (top - 1)) - left
        return _scaled(sticky.cast("double"), exponent, self.low + BITS * (top - 1) - BITS, self.low + BITS * (top - 1))


def _shift(x: Column, n: Column) -> Column:
    return F.call_function("shiftleft", x, n.cast("int"))


def _shift_right(x: Column, n: Column) -> Column:
    return F.call_function("shiftright", x, n.cast("int"))


def _scaled(x: Column, exponent: Column, least: int, most: int) -> Column:
    """x times two to the ``exponent`` (from ``least`` to ``most``), by two factors where one would leave the range of doubles."""
    if least >= -1000 and most <= 900:
        return x * F.pow(F.lit(2.0), exponent.cast("double"))
    half = F.floor(exponent / 2)
    return x * F.pow(F.lit(2.0), half.cast("double")) * F.pow(F.lit(2.0), (exponent - half).cast("double"))


def plan_sums(df: DataFrame, sums: dict[str, Column]) -> dict[str, ExactSum]:
    """How to cut the terms of each named sum over ``df``. One job: the least and the largest absolute value of the terms."""
    aggs = []
    for name, x in sums.items():
        size = F.when(_finite(x) & (x != 0), F.abs(x.cast("double")))
        aggs += [F.min(size).alias(f"{name}_least"), F.max(size).alias(f"{name}_most")]
    found = df.agg(*aggs).first()
    plans = {}
    for name in sums:
        least, most = found[f"{name}_least"] or 1.0, found[f"{name}_most"] or 1.0
        low = max(_LOWEST, math.frexp(least)[1] - 53)
        high = math.frexp(most)[1]
        plans[name] = ExactSum(name, low, max(1, -(-(high - low) // BITS)))
    return plans

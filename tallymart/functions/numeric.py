"""Money, scores and rounding.

Amounts are summed as whole units of their last digit in a BIGINT where that
fits: exact, order-independent, and narrow in the shuffle. Binary fractions are
cut into limbs of whole units first, each summed on its own. The result becomes
DECIMAL or DOUBLE at the edge.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, IntegralType

# Digits after the point up to which a DECIMAL is summed as BIGINT.
SHORT_DIGITS = 4
# Bits of a limb, which leave a BIGINT room for 2**42 rows, and limbs that a DOUBLE result is rounded from.
LIMB_BITS, LEADING_LIMBS = 20, 4
# Digits that a total may have beyond those of its largest amount.
GROWTH_DIGITS = 13


@dataclass(frozen=True)
class Amounts:
    """How the amounts of one column are summed without losing a digit.

    * Whole numbers, and decimals of up to 18 digits of which at most four
      follow the point: whole units of the last digit, as BIGINT.
    * Wider decimals: as they are, in sums of 38 digits. A total that needs
      more than 28 digits raises an error.
    * DOUBLE, FLOAT and text: the exact sum of the doubles, rounded once, in
      whatever order the rows come. A value is cut into whole multiples of
      powers of two, ``LIMB_BITS`` apart, from the ``top`` one down; each is
      summed as BIGINT. Powers and their number follow from the largest and
      the smallest value of the column. NaN and infinities are summed apart
      and decide the result where they occur.

    ``names``, ``units`` and what ``double`` and ``decimal`` take have one entry
    for each part of the sum.
    """

    digits: int
    wide: bool = False
    limbs: int = 0
    top: int = 0

    @classmethod
    def of(cls, df: DataFrame, column: str) -> Amounts:
        """For a column of doubles or text this reads the column's bounds, in a job."""
        kind: DataType = df.schema[column].dataType
        if isinstance(kind, DecimalType):
            return cls(kind.scale, wide=kind.precision > 18 or kind.scale > SHORT_DIGITS)
        if isinstance(kind, IntegralType):
            return cls(0)
        size = F.abs(_as_double(F.col(column)))
        size = F.when((size > 0) & (size < F.lit(float("inf"))) & ~F.isnan(size), size)
        bounds = df.agg(F.min(size).alias("least"), F.max(size).alias("most")).first()
        if bounds["most"] is None:
            return cls(0, limbs=1, top=0)
        # A double is a whole multiple of its last bit, 52 places below its first; no bit is below 2**-1074.
        last = max(math.frexp(bounds["least"])[1] - 53, -1074)
        limbs = max(1, math.ceil((math.frexp(bounds["most"])[1] - last) / LIMB_BITS))
        return cls(0, limbs=limbs, top=last + LIMB_BITS * (limbs - 1))

    def names(self, base: str) -> list[str]:
        """Columns that hold a value, or a sum of them, in parts."""
        if not self.limbs:
            return [base]
        return [*(f"{base}_{i}" for i in range(self.limbs)), f"{base}_odd"]

    def units(self, amount: Column) -> list[Column]:
        """A value of the column as what is summed."""
        if self.limbs:
            value = _as_double(amount)
            odd = F.isnan(value) | (F.abs(value) == F.lit(float("inf")))
            parts = self._cut(F.when(odd, F.lit(0.0)).otherwise(value))
            return [*(F.get(parts, F.lit(i)) for i in range(self.limbs)), F.when(odd, value).otherwise(value * 0)]
        if self.wide:
            return [amount.cast(self._decimal(28))]
        if self.digits == 0:
            return [amount.cast("bigint")]
        return [(amount * F.lit(10**self.digits).cast("decimal(5,0)")).cast("bigint")]

    def times(self, units: Column, count: Column) -> Column:
        """A part, or a sum of it, counted several times."""
        if self.wide:
            return units.cast(self._decimal(28)) * count.cast("decimal(9,0)")
        return units * count

    def decimal(self, parts: Sequence[Column]) -> Column:
        """A DECIMAL amount: exact, but for doubles as many digits as leave room for the total of all rows."""
        if self.limbs:
            whole = max(0, math.ceil((self.top + LIMB_BITS) * math.log10(2)))
            total = self.double(parts)
            finite = ~F.isnan(total) & (F.abs(total) < F.lit(float("inf")))
            return F.when(finite, total).cast(f"decimal(38,{max(0, 38 - GROWTH_DIGITS - whole)})")
        (units,) = parts
        if self.wide:
            return units.cast(self._decimal(38))
        scaled = units.cast("decimal(20,0)") / F.lit(10**self.digits).cast("decimal(5,0)")
        return scaled.cast(self._decimal(22))

    def double(self, parts: Sequence[Column]) -> Column:
        """A DOUBLE amount."""
        if self.limbs:
            *limbs, odd = parts
            return F.when(F.isnan(odd) | (F.abs(odd) == F.lit(float("inf"))), odd).otherwise(self._joined(limbs))
        (units,) = parts
        if self.wide:
            return units.cast("double")
        return units.cast("double") / F.lit(float(10**self.digits))

    def _places(self) -> list[int]:
        """Exponents of the limbs' units, highest first."""
        return [self.top - LIMB_BITS * i for i in range(self.limbs)]

    def _cut(self, value: Column) -> Column:
        """Limbs of a value, highest first. Each leaves at most half its unit, so every step is exact."""

        def step(state: Column, unit: Column) -> Column:
            limb = F.rint(state["rest"] / unit)
            rest = (state["rest"] - limb * unit).alias("rest")
            return F.struct(rest, F.concat(state["limbs"], F.array(limb.cast("bigint"))).alias("limbs"))

        units = F.array(*[F.lit(math.ldexp(1.0, place)) for place in self._places()])
        start = F.struct(value.alias("rest"), F.array().cast("array<bigint>").alias("limbs"))
        return F.when(value.isNotNull(), F.aggregate(units, start, step)["limbs"])

    def _joined(self, limbs: Sequence[Column]) -> Column:
        """The double next to the sum of the limbs' units."""
        base = 1 << LIMB_BITS

        def carried(sums: Column) -> Column:
            """What goes beyond the highest limb, and digits from 0 to ``base`` - 1, highest first."""

            def step(state: Column, limb: Column) -> Column:
                total = limb + state["over"]
                digit = F.pmod(total, F.lit(base))
                over = F.shiftright(total - digit, LIMB_BITS).alias("over")
                return F.struct(over, F.concat(F.array(digit), state["digits"]).alias("digits"))

            start = F.struct(F.lit(0).cast("bigint").alias("over"), F.array().cast("array<bigint>").alias("digits"))
            return F.aggregate(F.reverse(sums), start, step)

        sums = F.array(*limbs)
        negative = carried(sums)["over"] < 0
        split = carried(F.when(negative, F.transform(sums, lambda x: -x)).otherwise(sums))
        # What is carried out has a limb of its own, with a unit one limb up.
        places = F.array(*[F.lit(place) for place in (self.top + LIMB_BITS, *self._places())])
        zipped = F.arrays_zip(F.concat(F.array(split["over"]), split["digits"]).alias("d"), places.alias("p"))

        def lead(state: Column, limb: Column) -> Column:
            digit, skip = limb["d"], (state["taken"] == 0) & (limb["d"] == 0)
            full = state["taken"] == LEADING_LIMBS
            grown = (state["lead"] * F.lit(base).cast("decimal(7,0)") + digit.cast("decimal(19,0)")).cast("decimal(38,0)")
            return F.struct(
                F.when(full | skip, state["lead"]).otherwise(grown).alias("lead"),
                F.when(full | skip, state["place"]).otherwise(limb["p"]).alias("place"),
                F.when(full | skip, state["taken"]).otherwise(state["taken"] + 1).alias("taken"),
                (state["more"] | (full & (digit != 0))).alias("more"),
            )

        start = F.struct(
            F.lit(0).cast("decimal(38,0)").alias("lead"),
            F.lit(0).alias("place"),
            F.lit(0).alias("taken"),
            F.lit(False).alias("more"),
        )
        found = F.aggregate(zipped, start, lead)
        # Twice the leading limbs, and one more if anything follows: that decides halves, and nothing else.
        twice = found["lead"] * F.lit(2).cast("decimal(1,0)") + found["more"].cast("int").cast("decimal(1,0)")
        half = F.floor(found["place"] / 2).cast("int")
        size = twice.cast("double") / 2 * F.pow(F.lit(2.0), half) * F.pow(F.lit(2.0), found["place"] - half)
        known = sums[0].isNotNull()
        return F.when(known, F.when(negative, -size).otherwise(size))

    def _decimal(self, precision: int) -> str:
        return f"decimal({precision},{self.digits})"


def _as_double(amount: Column) -> Column:
    """Text, and the digits that a FLOAT shows, as DOUBLE."""
    return amount.cast("string").cast("double")


def ratio(part: Column, whole: Column) -> Column:
    """Double quotient; NULL when the whole is zero."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def round_away(value: Column, digits: int) -> Column:
    """Round a double half away from zero after scaling by a power of ten.

    This is how the oracle engine rounds doubles (1.005 to two digits is 1.0,
    because 1.005 * 100 is below 100.5), unlike a plain decimal-text ROUND.
    """
    scale = F.lit(float(10**digits))
    return F.round(value.cast("double") * scale) / scale


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or unknown."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))

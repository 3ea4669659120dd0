"""A space-filling order over time, price and quantity, as column expressions.

Each dimension becomes a whole number of BITS bits in its own order; the Z value interleaves
their bits. Rows near each other in Z are near in every dimension, so files and row groups in
that order have narrow ranges of all three.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._cols import as_col

#: Bits of a dimension; three of them fit a long.
BITS = 20
_TOP = (1 << BITS) - 1

# Steps and masks that leave two free bits after each bit of a number.
_STEPS = (
    (32, 0x1F00000000FFFF),
    (16, 0x1F0000FF0000FF),
    (8, 0x100F00F00F00F00F),
    (4, 0x10C30C30C30C30C3),
    (2, 0x1249249249249249),
)


def spread(number: Column) -> Column:
    """The low bits of a number with two zero bits between each two."""
    for shift, mask in _STEPS:
        number = number.bitwiseOR(F.shiftleft(number, shift)).bitwiseAND(F.lit(mask))
    return number


def interleave(a: Column, b: Column, c: Column) -> Column:
    """Z value of three numbers of BITS bits; null if any of them is."""
    return F.shiftleft(spread(a), 2).bitwiseOR(F.shiftleft(spread(b), 1)).bitwiseOR(spread(c))


def scaled(value: Column | str, low: float, high: float) -> Column:
    """A value of [low, high] as a number of BITS bits, in its order; outside it the nearest end."""
    width = high - low
    share = (as_col(value).cast("double") - F.lit(low)) / F.lit(width if width > 0 else 1.0)
    return F.floor(F.least(F.greatest(share, F.lit(0.0)), F.lit(1.0)) * _TOP).cast("bigint")


def _size(value: Column | str) -> Column:
    """Log scale for a price or quantity; what is not positive comes first."""
    value = as_col(value)
    return F.log2(F.when((value > 0) & (value < float("inf")), value).otherwise(F.lit(1e-12)))


def z_value(rows: DataFrame, time: str = "trade_time", price: str = "price", quantity: str = "quantity") -> Column:
    """Z value of trades, scaled to the ranges that `rows` have (one aggregate over them)."""
    dimensions = [F.unix_micros(time).cast("double"), _size(price), _size(quantity)]
    ends = rows.agg(*[f(d) for d in dimensions for f in (F.min, F.max)]).first()
    low, high = ([0.0 if e is None else e for e in ends[at::2]] for at in (0, 1))
    none = F.lit(0).cast("bigint")
    return interleave(*[F.coalesce(scaled(d, a, b), none) for d, a, b in zip(dimensions, low, high)])


def clustered(rows: DataFrame) -> DataFrame:
    """The rows dealt to files by ranges of their Z value and sorted by it in each."""
    keyed = rows.withColumn("_z", z_value(rows))
    return keyed.repartitionByRange("_z").sortWithinPartitions("_z").drop("_z")

"""Sums of doubles that do not depend on the order of the rows.

A double is cut into whole numbers of four powers of two, from 2**40 down to 2**-56, and each
of these is summed as a long: exact for values below 2**72 with no bits under 2**-56 (what lies
below is dropped, row by row), and the same for any order, partitioning or merging of runs. All
are column expressions over fixed-width longs, so the hash aggregate stays. What is not below
2**72, infinite or no number goes into a plain sum of its own.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._cols import as_col

#: Unit of each limb, the highest first; a limb of one row has at most 32 bits.
UNITS = {"3": 2.0**40, "2": 2.0**8, "1": 2.0**-24, "0": 2.0**-56}
FAR = "far"
LIMIT = 2.0**72
_WIDTH = 32
_MASK = (1 << _WIDTH) - 1


def names(name: str) -> list[str]:
    """Columns that hold a sum."""
    return [f"{name}_{limb}" for limb in (*UNITS, FAR)]


def sums(value: Column | str, name: str) -> list[Column]:
    """Aggregates over the rows of a group: the limbs' sums; nulls count as nothing."""
    value = as_col(value).cast("double")
    near = F.abs(value) < F.lit(LIMIT)
    rest = F.when(near, value)
    out = []
    for limb, unit in UNITS.items():
        # Scaling by powers of two, cutting towards zero and subtracting are all exact.
        number = (rest / F.lit(unit)).cast("bigint")
        rest = rest - number * F.lit(unit)
        out.append(F.coalesce(F.sum(number), F.lit(0).cast("bigint")).alias(f"{name}_{limb}"))
    return [*out, F.sum(F.when(~near, value)).alias(f"{name}_{FAR}")]


def merged(name: str) -> list[Column]:
    """Aggregates over rows that hold sums already."""
    return [F.sum(column).alias(column) for column in names(name)]


def _carried(limbs: list[Column]) -> list[Column]:
    """The same number with all limbs but the highest from 0 to 2**32 - 1."""
    out: list[Column] = []
    carry: Column | None = None
    for limb in reversed(limbs):
        number = limb if carry is None else limb + carry
        out.append(number.bitwiseAND(F.lit(_MASK)))
        carry = F.shiftright(number, _WIDTH)
        last = number
    return [last, *reversed(out[:-1])]


def carried(name: str) -> list[Column]:
    """The sum's columns with small limbs again, so that any number of them can be merged."""
    limbs = _carried([F.col(f"{name}_{limb}") for limb in UNITS])
    columns = [limb.alias(f"{name}_{unit}") for limb, unit in zip(limbs, UNITS)]
    return [*columns, F.col(f"{name}_{FAR}")]


def total(name: str) -> Column:
    """The sum as a double."""
    limbs = _carried([F.col(f"{name}_{limb}") for limb in UNITS])
    # A negative number keeps its precision as the positive one it is the opposite of.
    sign = F.when(limbs[0] < 0, F.lit(-1)).otherwise(F.lit(1)).cast("bigint")
    limbs = _carried([limb * sign for limb in limbs])
    parts = [limb.cast("double") * F.lit(unit) for limb, unit in zip(limbs, UNITS.values())]
    near = reduce(lambda low, high: high + low, reversed(parts)) * sign.cast("double")
    far = F.col(f"{name}_{FAR}")
    return F.when(far.isNull(), near).otherwise(near + far)

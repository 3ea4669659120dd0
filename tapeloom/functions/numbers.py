"""Number parsing and number texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._cols import as_col

# A plain cast also takes ' 1', '1d' and 'nan'; the feed never sends those.
_FLOAT = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def parse_float(text: Column | str) -> Column:
    """Double of a decimal number text, null if it is not one. May be infinite."""
    text = as_col(text)
    return F.when(text.rlike(_FLOAT), text.try_cast("double"))


def is_finite(value: Column | str) -> Column:
    value = as_col(value)
    return ~F.isnan(value) & (F.abs(value) != F.lit(float("inf")))


def money_text(value: Column | str) -> Column:
    """Two decimals, thousands groups set apart by spaces: `2 500 000.00`.

    format_number rounds half to even on the exact binary value; format_string does not.
    """
    return F.translate(F.format_number(as_col(value), 2), ",", " ")


def fixed6(value: Column | str) -> Column:
    """Six decimals without groups."""
    return F.translate(F.format_number(as_col(value), 6), ",", "")

"""Numeric keys that order trades by (time, aggregate id).

min / max / min_by / max_by keep the hash aggregate only while the ordering value has a
fixed-width type; ordering by a struct falls back to sorting every partition.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._cols import as_col

# A minute has 60,000,000 microseconds (26 bits), which leaves 37 bits of a non-negative
# long for the low part of an aggregate id; the high part is a grouping column.
LOW_BITS = 37
_LOW = (1 << LOW_BITS) - 1


def id_high(aggregate_id: Column | str) -> Column:
    """The part of an id above its low bits (signed); ids of one tape seldom have two."""
    return F.shiftright(as_col(aggregate_id), LOW_BITS)


def _low(aggregate_id: Column | str) -> Column:
    return as_col(aggregate_id).bitwiseAND(F.lit(_LOW))


def _in_minute(trade_time: Column | str) -> Column:
    return F.shiftleft(F.pmod(F.unix_micros(as_col(trade_time)), F.lit(60_000_000)), LOW_BITS)


def minute_first_key(trade_time: Column | str, aggregate_id: Column | str) -> Column:
    """Long that orders trades of one minute and one `id_high`; least = first, lower id on ties."""
    return _in_minute(trade_time) + _low(aggregate_id)


def minute_last_key(trade_time: Column | str, aggregate_id: Column | str) -> Column:
    """As above, but greatest = last, ties still to the lower id."""
    return _in_minute(trade_time) + (F.lit(_LOW) - _low(aggregate_id))


def key_time(key: Column | str, minute: Column | str) -> Column:
    """Epoch micros of the trade behind a key of this minute."""
    return F.unix_micros(as_col(minute)) + F.shiftright(as_col(key), LOW_BITS)


def key_id(key: Column | str, high: Column | str, last: bool = False) -> Column:
    """Aggregate id behind a first (or last) key."""
    low = as_col(key).bitwiseAND(F.lit(_LOW))
    return F.shiftleft(as_col(high), LOW_BITS) + (F.lit(_LOW) - low if last else low)


def first_order(micros: Column | str, aggregate_id: Column | str) -> Column:
    """decimal(38,0) of epoch micros and any id; least = first, ties to the lower id."""
    return _wide(as_col(micros), as_col(aggregate_id).cast("decimal(19,0)")).cast("decimal(38,0)")


def last_order(micros: Column | str, aggregate_id: Column | str) -> Column:
    """decimal(38,0); greatest = last, ties to the lower id."""
    return _wide(as_col(micros), -as_col(aggregate_id).cast("decimal(20,0)")).cast("decimal(38,0)")


def _wide(micros: Column, low: Column) -> Column:
    # 10^20 exceeds the span of a signed long, so times never overlap.
    step = F.lit("1" + "0" * 20).cast("decimal(21,0)")
    return micros.cast("decimal(18,0)") * step + low


def first_key(trade_time: Column | str, aggregate_id: Column | str) -> Column:
    """decimal(38,0) for any time and any id; least = first, ties to the lower id."""
    return first_order(F.unix_micros(as_col(trade_time)), aggregate_id)


def last_key(trade_time: Column | str, aggregate_id: Column | str) -> Column:
    """decimal(38,0); greatest = last, ties to the lower id."""
    return last_order(F.unix_micros(as_col(trade_time)), aggregate_id)

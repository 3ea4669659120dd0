"""Ids derived from natural keys, so that a retried task or a replayed batch repeats them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._cols import as_col


def trade_id(stream: Column | str, aggregate_id: Column | str) -> Column:
    return F.sha2(
        F.concat_ws("#", as_col(stream), as_col(aggregate_id).cast("string")), 256
    )


def frame_id(value: Column | str) -> Column:
    """Id of a frame that has no natural key."""
    return F.sha2(F.concat(F.lit("frame#"), F.coalesce(as_col(value), F.lit(""))), 256)


def event_id(event_type: Column | str, payload_id: Column | str) -> Column:
    return F.sha2(F.concat_ws("#", as_col(event_type), as_col(payload_id)), 256)

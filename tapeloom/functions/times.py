"""Time texts of the tape. Every text is in UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._cols import as_col

# date_format patterns of the three accepted time texts.
RFC3339_PATTERN = "yyyy-MM-dd'T'HH:mm:ss"
LEGACY_PATTERN = "yyyy-MM-dd HH:mm:ss"
LEGACY_SUFFIX = " +0000 UTC"

_RFC3339 = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?(Z|[+-]\d{2}:\d{2})$"


def _fraction(ts: Column) -> Column:
    """`.12` for .120000 s, empty for a whole second."""
    return F.rtrim(F.rtrim(F.date_format(ts, ".SSSSSS"), F.lit("0")), F.lit("."))


def rfc3339_nano(ts: Column | str) -> Column:
    ts = as_col(ts)
    return F.concat(F.date_format(ts, RFC3339_PATTERN), _fraction(ts), F.lit("Z"))


def rfc3339_seconds(ts: Column | str) -> Column:
    return F.concat(F.date_format(as_col(ts), RFC3339_PATTERN), F.lit("Z"))


def legacy_text(ts: Column | str) -> Column:
    ts = as_col(ts)
    return F.concat(F.date_format(ts, LEGACY_PATTERN), _fraction(ts), F.lit(LEGACY_SUFFIX))


def parse_rfc3339(text: Column | str) -> Column:
    """Timestamp of an RFC 3339 text, null for anything else."""
    text = as_col(text)
    return F.when(text.rlike(_RFC3339), text.try_cast("timestamp"))


def utc_date(ts: Column | str) -> Column:
    return F.date_format(as_col(ts), "yyyy-MM-dd")

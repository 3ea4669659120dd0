"""Filter / sort / limit queries over trades and notifications."""

from __future__ import annotations

import dataclasses
import datetime as dt
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeloom import schemas
from tapeloom.functions import patterns

# Longer id lists go through a semi join instead of a literal list in the plan.
LITERAL_LIST = 1000


@dataclass(frozen=True)
class NumericRange:
    """Bounds are AND-ed; any combination may be set."""

    eq: float | None = None
    ne: float | None = None
    gt: float | None = None
    gte: float | None = None
    lt: float | None = None
    lte: float | None = None


@dataclass(frozen=True)
class TimeRange:
    """Both ends inclusive."""

    after: dt.datetime | None = None
    before: dt.datetime | None = None


@dataclass(frozen=True)
class SortKey:
    """A key counts only if both its field and its direction are set."""

    field: str | None = None
    direction: str | None = None


@dataclass(frozen=True)
class TradeFilter:
    trade_id: str | None = None
    stream: str | None = None
    event_type: str | None = None
    aggregate_id: int | None = None
    symbol: str | None = None
    first_trade_id: int | None = None
    last_trade_id: int | None = None
    is_buyer_maker: bool | None = None
    price: NumericRange = field(default_factory=NumericRange)
    quantity: NumericRange = field(default_factory=NumericRange)
    event_time: TimeRange = field(default_factory=TimeRange)
    trade_time: TimeRange = field(default_factory=TimeRange)
    regex: str | None = None
    limit: int | None = None
    sort1: SortKey = field(default_factory=SortKey)
    sort2: SortKey = field(default_factory=SortKey)


@dataclass(frozen=True)
class NotificationFilter:
    event_time: str | None = None
    symbol: str | None = None
    is_buyer_maker: bool | None = None
    price: NumericRange = field(default_factory=NumericRange)
    quantity: NumericRange = field(default_factory=NumericRange)
    total_price: NumericRange = field(default_factory=NumericRange)
    regex: str | None = None
    limit: int | None = None
    sort1: SortKey = field(default_factory=SortKey)
    sort2: SortKey = field(default_factory=SortKey)
    # Internal, not part of the public filter; the list overrides the single id.
    trade_id: str | None = None
    trade_ids: Sequence[str] = ()


_COMPARISONS: dict[str, Callable[[Column, Column], Column]] = {
    "eq": lambda c, v: c == v,
    # A missing value counts as different.
    "ne": lambda c, v: ~c.eqNullSafe(v),
    "gt": lambda c, v: c > v,
    "gte": lambda c, v: c >= v,
    "lt": lambda c, v: c < v,
    "lte": lambda c, v: c <= v,
}


def equals(name: str, value: object | None) -> list[Column]:
    return [] if value is None else [F.col(name) == F.lit(value)]


def numeric_range(name: str, bounds: NumericRange) -> list[Column]:
    return [
        compare(F.col(name), F.lit(float(getattr(bounds, op))))
        for op, compare in _COMPARISONS.items()
        if getattr(bounds, op) is not None
    ]


def _instant(value: dt.datetime) -> Column:
    """A naive time is taken as UTC."""
    if value.tzinfo is None:
        value = value.replace(tzinfo=dt.timezone.utc)
    return F.lit(value.astimezone(dt.timezone.utc).isoformat()).cast("timestamp")


def time_range(name: str, bounds: TimeRange) -> list[Column]:
    found = []
    if bounds.after is not None:
        found.append(F.col(name) >= _instant(bounds.after))
    if bounds.before is not None:
        found.append(F.col(name) <= _instant(bounds.before))
    return found


def any_matches(names: Iterable[str], pattern: str | None) -> list[Column]:
    """Unanchored, case-insensitive search in any of the columns; empty = no filter."""
    return patterns.any_matches([F.col(name) for name in names], pattern) if pattern else []


def order_columns(keys: Iterable[SortKey], known: Iterable[str]) -> list[Column]:
    """Order list of the complete keys; unknown fields are refused."""
    known = set(known)
    orders = []
    for key in keys:
        if not key.field or not key.direction:
            continue
        if key.field not in known:
            raise ValueError(f"unknown sort field: {key.field}")
        if key.direction not in ("ASC", "DESC"):
            raise ValueError(f"unknown sort direction: {key.direction}")
        orders.append(F.col(key.field).asc() if key.direction == "ASC" else F.col(key.field).desc())
    return orders


def apply_limit(df: DataFrame, limit: int | None) -> DataFrame:
    """0 or None = all rows, a negative number counts as its absolute value."""
    return df.limit(abs(limit)) if limit else df


def _find(
    df: DataFrame,
    predicates: list[Column],
    keys: list[SortKey],
    limit: int | None,
    tie: str,
    fields: Sequence[str] | None,
) -> DataFrame:
    for predicate in predicates:
        df = df.where(predicate)
    orders = order_columns(keys, df.columns)
    if orders:
        # The id makes a limited result repeatable among equal keys.
        df = df.orderBy(*orders, F.col(tie).asc()) if limit else df.orderBy(*orders)
    df = apply_limit(df, limit)
    return df.select(*fields) if fields else df


def trade_predicates(f: TradeFilter) -> list[Column]:
    found: list[Column] = []
    for name in (
        "trade_id",
        "stream",
        "event_type",
        "aggregate_id",
        "symbol",
        "first_trade_id",
        "last_trade_id",
        "is_buyer_maker",
    ):
        found += equals(name, getattr(f, name))
    found += numeric_range("price", f.price) + numeric_range("quantity", f.quantity)
    found += time_range("event_time", f.event_time) + time_range("trade_time", f.trade_time)
    return found + any_matches(("stream", "event_type", "symbol"), f.regex)


def find_trades(trades: DataFrame, f: TradeFilter | None = None, fields: Sequence[str] | None = None) -> DataFrame:
    """Trades that meet every set option, in the asked order, cut to the limit."""
    f = f or TradeFilter()
    return _find(trades, trade_predicates(f), [f.sort1, f.sort2], f.limit, "trade_id", fields)


def notification_predicates(f: NotificationFilter) -> list[Column]:
    found: list[Column] = []
    for name in ("event_time", "symbol", "is_buyer_maker"):
        found += equals(name, getattr(f, name))
    for name in ("price", "quantity", "total_price"):
        found += numeric_range(name, getattr(f, name))
    found += any_matches(("event_time", "symbol"), f.regex)
    if not f.trade_ids:
        found += equals("trade_id", f.trade_id)
    elif len(f.trade_ids) <= LITERAL_LIST:
        found.append(F.col("trade_id").isin(list(f.trade_ids)))
    return found


def find_notifications(
    notifications: DataFrame,
    f: NotificationFilter | None = None,
    fields: Sequence[str] | None = None,
    trade_ids: DataFrame | None = None,
) -> DataFrame:
    """As `find_trades`; `trade_ids` (column `trade_id`) is the list as a table."""
    f = f or NotificationFilter()
    if trade_ids is None and len(f.trade_ids) > LITERAL_LIST:
        trade_ids = notifications.sparkSession.createDataFrame(
            [(i,) for i in f.trade_ids], "trade_id string"
        )
    if trade_ids is not None:
        notifications = notifications.join(
            trade_ids.select("trade_id").distinct(), "trade_id", "left_semi"
        ).select(*notifications.columns)
        f = dataclasses.replace(f, trade_id=None, trade_ids=())
    return _find(
        notifications, notification_predicates(f), [f.sort1, f.sort2], f.limit, "trade_id", fields
    )


def public_notifications(notifications: DataFrame) -> DataFrame:
    """The public shape carries no trade id."""
    return notifications.drop("trade_id")


def oldest(trades: DataFrame, n: int) -> DataFrame:
    """The n oldest trades by trade time (ties by id, null times first).

    Rows are counted per hour, then per second of the hour the n-th falls in, then per time of
    that second; what lies before is taken by a filter. Only trades of one single time are
    ever ordered, and no task holds more than the counts of an hour.
    """
    micros = F.unix_micros("trade_time")
    rest, left = trades, n
    parts: list[DataFrame] = []
    for unit in (3_600_000_000, 1_000_000, 1):
        at = micros - F.pmod(micros, F.lit(unit))
        upto = F.sum("rows").over(Window.orderBy(F.col("at").asc_nulls_first()))
        counts = rest.groupBy(at.alias("at")).agg(F.count(F.lit(1)).alias("rows"))
        reached = (
            counts.withColumn("upto", upto).where(F.col("upto") >= left)
            .orderBy("upto").select("at", "rows", "upto").first()
        )
        if reached is None:
            return trades
        if reached["at"] is not None:
            parts.append(rest.where(micros.isNull() | (at < reached["at"])))
        rest = rest.where(at.eqNullSafe(F.lit(reached["at"]).cast("bigint")))
        left -= reached["upto"] - reached["rows"]
    parts.append(rest.orderBy("trade_id").limit(left))
    return reduce(DataFrame.unionByName, parts)


def has_more(trades: DataFrame) -> DataFrame:
    """One row, `has_more`: whether any trade is left. Reads at most one row."""
    return trades.select(F.lit(1).alias("one")).limit(1).agg((F.count("one") > 0).alias("has_more"))


def _range(given: Mapping[str, object], cls: type, where: str) -> object:
    allowed = {f.name for f in dataclasses.fields(cls)}
    unknown = set(given) - allowed
    if unknown:
        raise ValueError(f"unknown option of {where}: {sorted(unknown)}")
    return cls(**{k: v for k, v in given.items() if v is not None})


def _mapped(given: Mapping[str, object] | None, cls: type, names: dict[str, str], public: set[str]) -> object:
    """A filter from its wire form: nested ranges, two sort fields with directions."""
    given = {k: v for k, v in (given or {}).items() if v is not None}
    wire = {wire: ours for ours, wire in names.items() if ours in public}
    ranges = {"price": NumericRange, "quantity": NumericRange, "total_price": NumericRange}
    if cls is TradeFilter:
        ranges |= {"event_time": TimeRange, "trade_time": TimeRange}
    options: dict[str, object] = {}
    sort: dict[str, object] = {}
    for key, value in given.items():
        if key in ("SortField1", "SortDir1", "SortField2", "SortDir2"):
            sort[key] = value
        elif key in ("Regex", "Limit"):
            options[key.lower()] = value
        elif key in wire and wire[key] in ranges:
            options[wire[key]] = _range(value, ranges[wire[key]], key)
        elif key in wire:
            options[wire[key]] = value
        else:
            raise ValueError(f"unknown filter field: {key}")
    for n in ("1", "2"):
        name = sort.get("SortField" + n)
        if name is not None and name not in names.values():
            raise ValueError(f"unknown sort field: {name}")
        ours = {w: o for o, w in names.items()}.get(name)
        options["sort" + n] = SortKey(ours, sort.get("SortDir" + n))
    return cls(**options)


def trade_filter(given: Mapping[str, object] | None) -> TradeFilter:
    """TradeFilter from its wire form, e.g. {"Symbol": "X", "Price": {"gt": 1.0}}."""
    return _mapped(given, TradeFilter, schemas.TRADE_WIRE, set(schemas.TRADE_WIRE))


def notification_filter(given: Mapping[str, object] | None) -> NotificationFilter:
    """NotificationFilter from its wire form; the trade id is not a public option."""
    names = schemas.NOTIFICATION_WIRE
    return _mapped(given, NotificationFilter, names, set(names) - {"trade_id"})

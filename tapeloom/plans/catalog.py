"""The registered queries, each next to the SQL that must give the same rows.

Results for comparison carry times without zone, and rounded averages (the summation
order differs between engines). Everything runs over the whole `events` table.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeloom import schemas
from tapeloom.functions import numbers, times
from tapeloom.operators import alerts, curate, filters, matching, purge, rollup
from tapeloom.operators.filters import NotificationFilter, NumericRange, SortKey, TimeRange, TradeFilter
from tapeloom.plans import lifecycle, tape
from tapeloom.session import work_dir
from tapeloom.sources import envelopes, frames, lake, upload
from tapeloom.sources.hot import HotStore
from tapeloom.streaming import ingest
from tapeloom.streaming import rollups as live

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

# --- shared SQL ------------------------------------------------------------------------


def _nano(ts: str) -> str:
    return rf"regexp_replace(strftime({ts}, '%Y-%m-%dT%H:%M:%S.%f'), '\.?0+$', '') || 'Z'"


def _legacy(ts: str) -> str:
    return rf"regexp_replace(strftime({ts}, '%Y-%m-%d %H:%M:%S.%f'), '\.?0+$', '') || ' +0000 UTC'"


def _trades_sql(name: str = "trades", event_time: str = "date_trunc('hour', ts)", trade_time: str = "ts") -> str:
    return f"""{name} as (
  select cast(event_id as varchar) as trade_id,
         lower(event_type) || 'usdt@aggTrade' as stream,
         'aggTrade' as event_type,
         {event_time} as event_time,
         event_id as aggregate_id,
         upper(event_type) || 'USDT' as symbol,
         value * 100.0 as price,
         cast(1 + (event_id * 37) % 200 as double) as quantity,
         event_id as first_trade_id,
         event_id + (event_id % 7) - 3 as last_trade_id,
         {trade_time} as trade_time,
         (event_id % 2) = 0 as is_buyer_maker
  from events)"""


_NOTIFICATIONS = f""", notifications as (
  select {_nano("event_time")} as event_time, price, quantity, symbol, is_buyer_maker,
         price * quantity as total_price, trade_id
  from trades where price * quantity > 2000000)"""

_FLAGGED = f""", ranked as (
  select *, row_number() over (partition by symbol, event_time order by trade_time, aggregate_id) as nth
  from trades),
flagged as (
  select r.* exclude (nth),
         nth = 1 and exists (select 1 from notifications n
           where n.symbol = r.symbol and n.event_time = {_nano("r.event_time")}) as triggered_notification
  from ranked r)"""

TRADES = "with " + _trades_sql()
NOTICES = TRADES + _NOTIFICATIONS
FLAGGED = NOTICES + _FLAGGED

_ROLLUP_COLUMNS = """min(price) as min_price, max(price) as max_price,
         round(avg(price), 4) as avg_price, sum(quantity) as volume,
         count(*) as trade_count,
         cast(count(*) filter (where triggered_notification) as bigint) as notifications_triggered,
         arg_min(price, row(trade_time, aggregate_id)) as first_price,
         arg_max(price, row(trade_time, -aggregate_id)) as last_price"""


def _rollup_sql(grain: str, source: str = "flagged") -> str:
    unit, name = schemas.GRAINS[grain]
    return f"""
  select symbol, strftime(date_trunc('{unit}', trade_time), '%Y-%m-%d') as date,
         cast(date_trunc('{unit}', trade_time) as timestamp) as {name},
         {_ROLLUP_COLUMNS}
  from {source} group by 1, 2, 3"""


def query(name: str, sql: str | None) -> Callable[[Query], Query]:
    """Register a query and, where SQL can express it, its equivalent."""

    def add(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return _plain(fn(spark, sf_dir))

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return add


def _plain(df: DataFrame) -> DataFrame:
    """Times without zone (UTC), as the SQL side has them."""
    return df.select(
        *[
            F.col(f.name).cast("timestamp_ntz").alias(f.name)
            if isinstance(f.dataType, T.TimestampType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def _rounded(rows: DataFrame) -> DataFrame:
    return rows.withColumn("avg_price", F.round("avg_price", 4))


def _flagged(spark: SparkSession, sf: str) -> DataFrame:
    return matching.flag_trades(tape.trades(spark, sf), tape.notifications(spark, sf))


# --- frames and envelopes --------------------------------------------------------------


@query(
    "decode_frames",
    TRADES
    + """ select * replace (
    sha256(stream || '#' || aggregate_id) as trade_id,
    date_trunc('millisecond', event_time) as event_time,
    date_trunc('millisecond', trade_time) as trade_time) from trades""",
)
def _(spark, sf):
    return frames.decode_frames(frames.encode_frames(tape.trades(spark, sf)))


def _damaged_frames(spark: SparkSession, sf: str) -> DataFrame:
    """Every frame, most of them damaged in a way that depends on the event id.

    Kinds 6 and 7 end in white space and are good frames.
    """
    good = frames.encode_frames(tape.trades(spark, sf))
    frame, n = F.col("value"), F.regexp_extract("value", r'"a":(\d+)', 1)
    kind = n.cast("bigint") % 11
    damaged = (
        F.when(kind == 1, F.concat(F.lit("not json "), n))
        .when(kind == 2, F.regexp_replace(frame, r'"p":"[^"]*"', '"p":"abc"'))
        .when(kind == 3, F.regexp_replace(frame, r'"p":"[^"]*"', '"p":"1e999"'))
        .when(kind == 4, F.regexp_replace(frame, r'"a":(\d+)', '"a":"$1"'))
        .when(kind == 5, frame.substr(F.lit(1), F.length(frame) - 3))
        .when(kind == 6, F.concat(frame, F.lit("\n")))
        .when(kind == 7, F.concat(frame, F.lit("\t ")))
        .when(kind == 8, F.concat(frame, F.lit("}")))
        .when(kind == 9, F.concat(frame, frame))
        .when(kind == 10, F.regexp_replace(frame, r'"p":"([^"]*)"', '"p":$1'))
        .otherwise(frame)
    )
    return good.select(damaged.alias("value"))


@query(
    "quarantine_frames",
    """select cast(event_id as bigint) as frame_number,
  case event_id % 11 when 2 then 'bad_price' when 3 then 'not_finite' else 'undecodable' end as reason
  from events where event_id % 11 not in (0, 6, 7)""",
)
def _(spark, sf):
    number = F.regexp_extract("value", r'(?:"a":"?|not json )(\d+)', 1).cast("bigint")
    rejects = frames.quarantine_frames(_damaged_frames(spark, sf))
    return rejects.select(number.alias("frame_number"), "reason")


@query(
    "zero_filled_frames",
    TRADES
    + f""", kinds as (select *, aggregate_id % 11 as kind from trades)
  select case when kind in (1, 4, 5, 8, 9, 10) then '' else stream end as stream,
         case when kind in (1, 4, 5, 8, 9, 10) then '' else symbol end as symbol,
         case when kind in (1, 4, 5, 8, 9, 10) then '0001-01-01T00:00:00Z' else {_nano("event_time")} end as event_time,
         case when kind in (1, 4, 5, 8, 9, 10) then 0 else aggregate_id end as aggregate_id,
         case when kind in (0, 6, 7) then price else 0.0 end as price,
         case when kind in (1, 4, 5, 8, 9, 10) then 0.0 else quantity end as quantity,
         case when kind in (1, 4, 5, 8, 9, 10) then false else is_buyer_maker end as is_buyer_maker
  from kinds where kind <> 3""",
)
def _(spark, sf):
    rows = frames.decode_frames(_damaged_frames(spark, sf), on_bad_frame="zero")
    return rows.select(
        "stream",
        "symbol",
        times.rfc3339_nano("event_time").alias("event_time"),
        "aggregate_id",
        "price",
        "quantity",
        "is_buyer_maker",
    )


@query(
    "subscribe_symbols",
    TRADES + " select * from trades where stream in ('clickusdt@aggTrade', 'viewusdt@aggTrade')",
)
def _(spark, sf):
    return frames.subscribe_symbols(tape.trades(spark, sf), "ClickUSDT , viewusdt")


@query(
    "assign_trade_id",
    TRADES
    + " select stream, aggregate_id, sha256(stream || '#' || aggregate_id) as trade_id from trades",
)
def _(spark, sf):
    decoded = frames.decode_frames(frames.encode_frames(tape.trades(spark, sf)))
    return decoded.select("stream", "aggregate_id", "trade_id")


@query(
    "wrap_envelope",
    NOTICES
    + """ select sha256('BinanceTradeEvent#' || trade_id) as id, 'BinanceTradeEvent' as type,
    'WebSocketStreamServer' as source, 'consumer.mongo,consumer.telegrambot' as subscribers from trades
  union all select sha256('NotificationEvent#' || trade_id), 'NotificationEvent', 'TelegramBot',
    'consumer.mongo' from notifications""",
)
def _(spark, sf):
    return _envelopes(spark, sf).select(
        "id", "type", "source", F.concat_ws(",", "subscribers").alias("subscribers")
    )


def _envelopes(spark: SparkSession, sf: str) -> DataFrame:
    created = F.lit("2024-01-31 00:00:00 +0000 UTC")
    return envelopes.wrap_trades(tape.trades(spark, sf), created).unionByName(
        envelopes.wrap_notifications(tape.notifications(spark, sf), created)
    )


@query("wrap_unwrap_envelope", TRADES + " select * from trades")
def _(spark, sf):
    wire = envelopes.to_wire(_envelopes(spark, sf))
    return envelopes.unwrap(envelopes.parse_envelopes(wire), schemas.TRADE_EVENT)


@query("unwrap_notifications", NOTICES + " select * from notifications")
def _(spark, sf):
    wire = envelopes.to_wire(_envelopes(spark, sf))
    return envelopes.unwrap(envelopes.parse_envelopes(wire), schemas.NOTIFICATION_EVENT)


_COPIES = NOTICES + """, copies as (
  select unnest(['consumer.mongo', 'consumer.telegrambot']) as subscriber,
         'BinanceTradeEvent' as type, sha256('BinanceTradeEvent#' || trade_id) as id from trades
  union all select 'consumer.mongo', 'NotificationEvent', sha256('NotificationEvent#' || trade_id)
  from notifications)
  select subscriber, type, id from copies"""


@query("fan_out", _COPIES)
def _(spark, sf):
    return envelopes.fan_out(_envelopes(spark, sf)).select("subscriber", "type", "id")


@query(
    "route_by_type",
    NOTICES
    + """ select 'BinanceTradeEvent' as type, symbol, count(*) as events from trades group by 2
  union all select 'NotificationEvent', symbol, count(*) from notifications group by 2""",
)
def _(spark, sf):
    path = work_dir(spark, "route")
    _envelopes(spark, sf).write.partitionBy("type").parquet(path)
    stored = spark.read.parquet(path)
    symbol = F.get_json_object("event_data", "$.Symbol").alias("symbol")
    return stored.groupBy("type", symbol).agg(F.count(F.lit(1)).alias("events"))


@query(
    "dedup_events",
    TRADES + " select sha256('BinanceTradeEvent#' || trade_id) as id, 'BinanceTradeEvent' as type from trades",
)
def _(spark, sf):
    sent = envelopes.wrap_trades(tape.trades(spark, sf), F.lit(""))
    again = sent.unionByName(sent)
    return envelopes.dedup_events(again).select("id", "type")


# --- filter / sort / limit -------------------------------------------------------------


def _trade_query(name: str, where: str, f: TradeFilter) -> None:
    @query(name, TRADES + f" select * from trades where {where}")
    def _(spark, sf):
        return filters.find_trades(tape.trades(spark, sf), f)


def _notice_query(name: str, where: str, f: NotificationFilter) -> None:
    @query(name, NOTICES + f" select * from notifications where {where}")
    def _(spark, sf):
        return filters.find_notifications(tape.notifications(spark, sf), f)


_trade_query(
    "trades_eq_string",
    "symbol = 'CLICKUSDT' and stream = 'clickusdt@aggTrade' and event_type = 'aggTrade'",
    TradeFilter(symbol="CLICKUSDT", stream="clickusdt@aggTrade", event_type="aggTrade"),
)
_trade_query("trades_eq_id", "trade_id = '137'", TradeFilter(trade_id="137"))
_trade_query("trades_eq_int", "aggregate_id = 501 and first_trade_id = 501", TradeFilter(aggregate_id=501, first_trade_id=501))
_trade_query("trades_eq_bool", "is_buyer_maker", TradeFilter(is_buyer_maker=True))
_trade_query(
    "trades_price_range",
    "price > 1000 and price <= 9000 and quantity >= 20 and quantity < 150",
    TradeFilter(price=NumericRange(gt=1000, lte=9000), quantity=NumericRange(gte=20, lt=150)),
)
_trade_query("trades_quantity_eq", "quantity = 38", TradeFilter(quantity=NumericRange(eq=38)))
_trade_query("trades_quantity_ne", "quantity <> 38", TradeFilter(quantity=NumericRange(ne=38)))
_trade_query(
    "trades_time_range",
    "event_time between timestamp '2024-01-05 00:00:00' and timestamp '2024-01-12 06:00:00'"
    " and trade_time >= timestamp '2024-01-06 00:00:00'",
    TradeFilter(
        event_time=TimeRange(dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 12, 6)),
        trade_time=TimeRange(after=dt.datetime(2024, 1, 6)),
    ),
)
_trade_query(
    "trades_regex",
    "regexp_matches(stream, '^(cli|ERR)', 'i') or regexp_matches(event_type, '^(cli|ERR)', 'i')"
    " or regexp_matches(symbol, '^(cli|ERR)', 'i')",
    TradeFilter(regex="^(cli|ERR)"),
)
_trade_query("limit_zero", "is_buyer_maker", TradeFilter(is_buyer_maker=True, limit=0, regex=""))

_notice_query(
    "notif_eq",
    "symbol = 'ERRORUSDT' and is_buyer_maker",
    NotificationFilter(symbol="ERRORUSDT", is_buyer_maker=True),
)
_notice_query(
    "notif_eq_time",
    "event_time = '2024-01-09T09:00:00Z'",
    NotificationFilter(event_time="2024-01-09T09:00:00Z"),
)
_notice_query(
    "notif_total_range",
    "total_price >= 2100000 and total_price < 4000000 and price <> 20000 and quantity > 100",
    NotificationFilter(
        total_price=NumericRange(gte=2_100_000, lt=4_000_000),
        price=NumericRange(ne=20_000),
        quantity=NumericRange(gt=100),
    ),
)
_notice_query(
    "notif_regex",
    "regexp_matches(event_time, '-01-1|view', 'i') or regexp_matches(symbol, '-01-1|view', 'i')",
    NotificationFilter(regex="-01-1|view"),
)
@query(
    "notif_trade_id",
    NOTICES + " select * from notifications where trade_id = (select min(trade_id) from notifications)",
)
def _(spark, sf):
    notices = tape.notifications(spark, sf)
    least = notices.agg(F.min("trade_id")).first()[0]
    return filters.find_notifications(notices, NotificationFilter(trade_id=least))


@query(
    "notif_trade_ids",
    NOTICES + " select * from notifications where trade_id in (select trade_id from trades where is_buyer_maker)",
)
def _(spark, sf):
    # The list wins over the single id.
    wanted = filters.find_trades(tape.trades(spark, sf), TradeFilter(is_buyer_maker=True), ["trade_id"])
    return filters.find_notifications(
        tape.notifications(spark, sf), NotificationFilter(trade_id="13"), trade_ids=wanted
    )


@query("sort_two_keys", TRADES + " select * from trades order by symbol, price desc")
def _(spark, sf):
    f = TradeFilter(sort1=SortKey("symbol", "ASC"), sort2=SortKey("price", "DESC"))
    return filters.find_trades(tape.trades(spark, sf), f)


@query(
    "top_k",
    TRADES + " select * from trades order by price desc, quantity, trade_id limit 100",
)
def _(spark, sf):
    f = filters.trade_filter(
        {"SortField1": "Price", "SortDir1": "DESC", "SortField2": "Quantity", "SortDir2": "ASC", "Limit": 100}
    )
    return filters.find_trades(tape.trades(spark, sf), f)


@query(
    "limit_negative",
    NOTICES + " select * from notifications order by total_price, trade_id limit 3",
)
def _(spark, sf):
    # A key without a field is ignored; the second key alone is the primary one.
    f = NotificationFilter(sort1=SortKey(None, "DESC"), sort2=SortKey("total_price", "ASC"), limit=-3)
    return filters.find_notifications(tape.notifications(spark, sf), f)


@query("projection", TRADES + " select symbol, price from trades where price > 5000")
def _(spark, sf):
    f = filters.trade_filter({"Price": {"gt": 5000}})
    return filters.find_trades(tape.trades(spark, sf), f, ["symbol", "price"])


@query("public_notifications", NOTICES + " select * exclude (trade_id) from notifications")
def _(spark, sf):
    return filters.public_notifications(tape.notifications(spark, sf))


@query("has_more", TRADES + " select count(*) > 0 as has_more from trades")
def _(spark, sf):
    return filters.has_more(tape.trades(spark, sf))


@query("oldest_batch", TRADES + " select * from trades order by trade_time, trade_id limit 25")
def _(spark, sf):
    return filters.oldest(tape.trades(spark, sf), 25)


# --- alerts ----------------------------------------------------------------------------


@query("detect_alerts", TRADES + " select * from trades where price * quantity > 2000000")
def _(spark, sf):
    return alerts.detect_alerts(tape.trades(spark, sf))


_MONEY = "replace(format('{:,.2f}', price * quantity), ',', ' ')"
_MESSAGE = (
    "'🚨 *Trade Alert!*' || chr(10) || 'Symbol: ' || symbol || chr(10) || 'Price: ' || format('{:.6f}', price)"
    f" || chr(10) || 'Qty: ' || format('{{:.6f}}', quantity) || chr(10) || 'TotalPrice: ' || {_MONEY}"
)


@query(
    "alert_message",
    TRADES + f" select trade_id, {_MESSAGE} as message from trades where price * quantity > 2000000",
)
def _(spark, sf):
    return alerts.alert_messages(tape.trades(spark, sf))


@query(
    "money_text",
    TRADES + f" select trade_id, price * quantity as notional, {_MONEY} as text from trades",
)
def _(spark, sf):
    trades = tape.trades(spark, sf)
    return trades.select(
        "trade_id",
        alerts.notional().alias("notional"),
        numbers.money_text(alerts.notional()).alias("text"),
    )


@query("build_notifications", NOTICES + " select * from notifications")
def _(spark, sf):
    return tape.notifications(spark, sf)


# --- matching --------------------------------------------------------------------------

_SPLIT = "date_trunc('hour', ts) + to_milliseconds((event_id % 4) * 250)"


def _texts(ts: str) -> str:
    seconds = f"strftime({ts}, '%Y-%m-%dT%H:%M:%SZ')"
    return f"list_distinct([{_nano(ts)}, {seconds}, {_legacy(ts)}])"


_KEYS = "with " + _trades_sql(event_time=_SPLIT) + f""", texts as (
  select trade_id, symbol, {_nano("event_time")} as k1,
         strftime(event_time, '%Y-%m-%dT%H:%M:%SZ') as k2, {_legacy("event_time")} as k3 from trades),
keys as (
  select trade_id, symbol, 0 as priority, k1 as event_time from texts
  union all select trade_id, symbol, 1, k2 from texts where k2 <> k1
  union all select trade_id, symbol, case when k2 <> k1 then 2 else 1 end, k3 from texts)"""


@query("notification_keys", _KEYS + " select trade_id, symbol, cast(priority as integer) as priority, event_time from keys")
def _(spark, sf):
    return matching.notification_keys(tape.split_second_trades(spark, sf))


@query("distinct_keys", _KEYS + " select distinct symbol, event_time from keys")
def _(spark, sf):
    return matching.distinct_keys(tape.split_second_trades(spark, sf))


@query(
    "lookup_first_notification",
    NOTICES
    + """ select * from notifications
  qualify row_number() over (partition by symbol, event_time order by trade_id) = 1""",
)
def _(spark, sf):
    return matching.lookup_first_notification(tape.trades(spark, sf), tape.notifications(spark, sf))


@query("flag_exact", FLAGGED + " select trade_id, symbol, event_time, triggered_notification from flagged")
def _(spark, sf):
    return _flagged(spark, sf).select("trade_id", "symbol", "event_time", "triggered_notification")


@query(
    "flag_by_trade_id",
    NOTICES
    + """ select trade_id, symbol, event_time,
    trade_id in (select trade_id from notifications) as triggered_notification from trades""",
)
def _(spark, sf):
    flagged = matching.flag_trades(tape.trades(spark, sf), tape.notifications(spark, sf), "by_trade_id")
    return flagged.select("trade_id", "symbol", "event_time", "triggered_notification")


def _mixed_notifications(trades: DataFrame) -> DataFrame:
    """Notifications of a low threshold, a third of them in the legacy layout."""
    large = alerts.detect_alerts(trades, 200_000)
    text = F.when(F.col("aggregate_id") % 3 == 0, times.legacy_text("event_time")).otherwise(
        times.rfc3339_nano("event_time")
    )
    return large.select(
        text.alias("event_time"),
        "price",
        "quantity",
        "symbol",
        "is_buyer_maker",
        alerts.notional().alias("total_price"),
        "trade_id",
    )


_COMPAT = "with " + _trades_sql(event_time=_SPLIT) + f""", stored as (
  select distinct symbol, event_time as at, aggregate_id % 3 = 0 as legacy
  from trades where price * quantity > 200000),
ranked as (
  select *, date_trunc('second', event_time) as sec,
         row_number() over (partition by symbol, event_time order by trade_time, aggregate_id) as nth
  from trades),
keyed as (
  select r.*,
    exists (select 1 from stored s where s.symbol = r.symbol and s.at = r.event_time
            and not s.legacy and r.event_time <> r.sec) as own,
    exists (select 1 from stored s where s.symbol = r.symbol and s.at = r.event_time and s.legacy) as old,
    exists (select 1 from stored s where s.symbol = r.symbol and s.at = r.sec and not s.legacy) as shared
  from ranked r),
waiting as (select *, nth - case when own then 1 else 0 end as place from keyed),
taker as (
  select trade_id from waiting where shared and place = 1
  qualify row_number() over (partition by symbol, sec order by trade_time, aggregate_id) = 1),
result as (
  select w.*, w.trade_id in (select trade_id from taker) as took,
    bool_or(w.trade_id in (select trade_id from taker)) over (partition by symbol, event_time) as group_took
  from waiting w)
select trade_id, symbol, event_time,
  (own and nth = 1) or took or (old and place = case when group_took then 2 else 1 end) as triggered_notification
from result"""


@query("flag_compat", _COMPAT)
def _(spark, sf):
    trades = tape.split_second_trades(spark, sf)
    flagged = matching.flag_trades(trades, _mixed_notifications(trades), "compat")
    return flagged.select("trade_id", "symbol", "event_time", "triggered_notification")


# --- deletes ---------------------------------------------------------------------------


@query("purge_trades", TRADES + " select * from trades where not (price * quantity > 200000)")
def _(spark, sf):
    trades = tape.trades(spark, sf)
    return purge.purge_trades(trades, alerts.detect_alerts(trades, 200_000))


@query(
    "purge_notifications_by_key",
    NOTICES
    + """ select * from notifications n where symbol <> 'VIEWUSDT'
  and event_time not in (select event_time from notifications where symbol = 'VIEWUSDT')
  and not exists (select 1 from flagged_keys k where k.symbol = n.symbol and k.trade_id = n.trade_id)""".replace(
        "flagged_keys", "(select symbol, trade_id from notifications where quantity > 150)"
    ),
)
def _(spark, sf):
    notices = tape.notifications(spark, sf)
    none = F.lit(None).cast("string")
    of_symbol = notices.where("symbol = 'VIEWUSDT'")
    keys = (
        of_symbol.select("symbol", none.alias("event_time"), none.alias("trade_id"))
        .unionByName(of_symbol.select(F.lit("").alias("symbol"), "event_time", none.alias("trade_id")))
        .unionByName(
            notices.where("quantity > 150").select("symbol", none.alias("event_time"), "trade_id")
        )
    )
    return purge.purge_notifications_by_key(notices, keys)


@query(
    "purge_notifications_by_trade_id",
    NOTICES + " select * from notifications where quantity <= 150",
)
def _(spark, sf):
    notices = tape.notifications(spark, sf)
    return purge.purge_notifications_by_trade_id(notices, notices.where("quantity > 150"))


# --- curated and rollups ---------------------------------------------------------------

_AMOUNT = "greatest(last_trade_id - first_trade_id + 1, 0)"


@query(
    "processed_projection",
    FLAGGED
    + f""" select trade_time, symbol, price, quantity, {_AMOUNT} as amount_of_trades, is_buyer_maker,
    triggered_notification from flagged""",
)
def _(spark, sf):
    return curate.processed(_flagged(spark, sf))


_CURATED = f""" select symbol, date_trunc('millisecond', trade_time) as trade_time, price, quantity,
    {_AMOUNT} as amount_of_trades, is_buyer_maker, triggered_notification,
    strftime(trade_time, '%Y-%m-%d') as date from flagged"""


@query("curate_trades", FLAGGED + _CURATED)
def _(spark, sf):
    return curate.curate_trades(tape.trades(spark, sf), tape.notifications(spark, sf))


def _rollup_query(name: str, grain: str) -> None:
    @query(name, FLAGGED + _rollup_sql(grain))
    def _(spark, sf):
        return _rounded(rollup.rollup(_flagged(spark, sf), grain))


_rollup_query("minute_rollup", "minute")
_rollup_query("hourly_rollup", "hourly")
_rollup_query("daily_rollup", "daily")

_TIED = "with " + _trades_sql(trade_time="date_trunc('hour', ts)") + ", flagged as (select *, false as triggered_notification from trades)"


@query("tied_rollup", _TIED + _rollup_sql("daily"))
def _(spark, sf):
    trades = tape.tied_trades(spark, sf).withColumn("triggered_notification", F.lit(False))
    return _rounded(rollup.rollup(trades, "daily"))


# Ids on both sides of 2^37, negative ones, and the far ends of a long, in every hour.
_FAR_IDS = """case aggregate_id % 5 when 0 then aggregate_id when 1 then 137438953472 - 20000 + aggregate_id
  when 2 then -aggregate_id when 3 then 9223372036854775807 - aggregate_id
  else -9223372036854775807 + aggregate_id end"""
_FAR = (
    "with " + _trades_sql(trade_time="date_trunc('hour', ts)")
    + f", flagged as (select * replace ({_FAR_IDS} as aggregate_id), false as triggered_notification from trades)"
)


def _far_ids(spark: SparkSession, sf: str) -> DataFrame:
    return (
        tape.tied_trades(spark, sf)
        .withColumn("triggered_notification", F.lit(False))
        .withColumn("aggregate_id", F.expr(_FAR_IDS))
    )


@query("far_id_runs", _FAR + _rollup_sql("hourly"))
def _(spark, sf):
    """Three runs with ids of every size, merged from the lake."""
    path = work_dir(spark, "far-ids")
    rows = _far_ids(spark, sf)
    for run in range(3):
        part = rows.where(F.pmod("aggregate_id", F.lit(3)) == run)
        lake.write_state(rollup.minute_state(part), path, f"run-{run}")
    return _rounded(lake.read_merged_rollups(spark, path, "hourly"))


@query("wide_id_rollup", _FAR + _rollup_sql("hourly"))
def _(spark, sf):
    trades = _far_ids(spark, sf)
    return _rounded(rollup.rollup(trades, "hourly"))


_ALL_GRAINS = FLAGGED + """ select grain, symbol, start, min_price, max_price, avg_price, volume, trade_count,
  notifications_triggered, first_price, last_price from (""" + " union all ".join(
    f"select '{grain}' as grain, * rename ({name} as start) from ({_rollup_sql(grain)})"
    for grain, (_, name) in schemas.GRAINS.items()
) + ")"


@query("rollup_hierarchy", _ALL_GRAINS)
def _(spark, sf):
    """All grains of one run, written and read back."""
    path = work_dir(spark, "rollups")
    lifecycle.write_rollups(rollup.minute_state(_flagged(spark, sf)), path, "run-1")
    parts = [
        _rounded(lake.read_rollups(spark, path, grain))
        .withColumnRenamed(name, "start")
        .withColumn("grain", F.lit(grain))
        .drop("date")
        for grain, (_, name) in schemas.GRAINS.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "merge_partials",
    FLAGGED + f" select * exclude (first_price, last_price) from ({_rollup_sql('hourly')})",
)
def _(spark, sf):
    """Rows four runs published for the same hours, combined."""
    by_run = _flagged(spark, sf).withColumn("run", F.col("aggregate_id") % 4)
    rows = rollup.publish(rollup.minute_state(by_run, by=("run",)), "hourly", by=("run",))
    return _rounded(rollup.merge_partials(rows, "hourly"))


@query("merge_states", FLAGGED + _rollup_sql("hourly"))
def _(spark, sf):
    by_run = _flagged(spark, sf).withColumn("run", F.col("aggregate_id") % 4)
    states = rollup.minute_state(by_run, by=("run",)).drop("run")
    return _rounded(rollup.publish(rollup.merge_states(states), "hourly"))


@query(
    "partition_counts",
    TRADES
    + """ select symbol, strftime(trade_time, '%Y-%m-%d') as date, count(*) as rows from trades group by 1, 2""",
)
def _(spark, sf):
    return lake.partition_counts(
        tape.trades(spark, sf), "symbol", times.utc_date("trade_time").alias("date")
    )


# --- lake ------------------------------------------------------------------------------


@query("raw_archive_roundtrip", TRADES + " select * from trades")
def _(spark, sf):
    path = work_dir(spark, "raw")
    lake.archive_raw_trades(tape.trades(spark, sf), path, "run-1")
    return lake.read_raw_trades(spark, path)


@query("raw_notifications_roundtrip", NOTICES + " select * from notifications")
def _(spark, sf):
    path = work_dir(spark, "raw")
    lake.archive_raw_notifications(tape.notifications(spark, sf), path, "run-1")
    return lake.read_raw_notifications(spark, path)


@query("legacy_archive", TRADES + " select * from trades")
def _(spark, sf):
    """Lines of up to 25 records without separators, as archived in batches of 25."""
    path = work_dir(spark, "legacy")
    record = envelopes.payload_json(schemas.TRADE, schemas.TRADE_WIRE)
    lines = (
        tape.trades(spark, sf)
        .select(F.floor(F.col("aggregate_id") / 25).alias("batch"), record.alias("record"))
        .groupBy("batch")
        .agg(F.concat_ws("", F.collect_list("record")).alias("value"))
    )
    lines.select("value").write.option("compression", "gzip").text(path)
    return lake.read_raw_trades(spark, path, legacy=True)


@query("curated_roundtrip", FLAGGED + _CURATED)
def _(spark, sf):
    path = work_dir(spark, "curated")
    rows = curate.curated(curate.processed(_flagged(spark, sf)))
    lake.write_curated(rows, path, "run-1")
    return lake.read_curated(spark, path)


@query("curated_pruned", FLAGGED + f" select * from ({_CURATED}) where symbol = 'CLICKUSDT' and date >= '2024-01-20'")
def _(spark, sf):
    path = work_dir(spark, "curated")
    rows = curate.curated(curate.processed(_flagged(spark, sf)))
    lake.write_curated(rows, path, "run-1")
    return lake.read_curated(spark, path).where("symbol = 'CLICKUSDT' and date >= '2024-01-20'")


@query("rollup_roundtrip", FLAGGED + _rollup_sql("hourly"))
def _(spark, sf):
    """Two runs over the same hours, read back as one row per hour."""
    path = work_dir(spark, "rollups")
    flagged = _flagged(spark, sf)
    for run in (0, 1):
        part = flagged.where(F.col("aggregate_id") % 2 == run)
        lake.write_state(rollup.minute_state(part), path, f"run-{run}")
    return _rounded(lake.read_merged_rollups(spark, path, "hourly"))


_STRAY = f"""with {_trades_sql()}{_NOTIFICATIONS}, moved as (
  select * replace (case when cast(trade_id as bigint) % 5 = 0
    then replace(event_time, ':00:00Z', ':30:00Z') else event_time end as event_time) from notifications),
places as (
  select 'raw_trades' as place, symbol from trades
  union all select 'curated', symbol from trades
  union all select distinct_kept.place, symbol from (
    select distinct 'raw_notifications' as place, symbol, event_time from moved
    where event_time like '%:00:00Z') distinct_kept
  union all select distinct_kept.place, symbol from (
    select distinct 'flagged' as place, symbol, event_time from moved
    where event_time like '%:00:00Z') distinct_kept
  union all select 'hot_notifications', symbol from moved where event_time like '%:30:00Z')
select place, symbol, count(*) as rows from places group by 1, 2"""


@query("archive_and_purge", _STRAY)
def _(spark, sf):
    """End state of a drain: what is where, by symbol."""
    hot = HotStore(spark, work_dir(spark, "hot"))
    paths = lifecycle.LakePaths(work_dir(spark, "lake"))
    stray = F.when(
        F.col("trade_id").cast("bigint") % 5 == 0,
        F.replace("event_time", F.lit(":00:00Z"), F.lit(":30:00Z")),
    ).otherwise(F.col("event_time"))
    notices = tape.notifications(spark, sf).withColumn("event_time", stray)
    hot.append("a", {lifecycle.TRADES: tape.trades(spark, sf), lifecycle.NOTIFICATIONS: notices})
    lifecycle.drain(hot, paths, "run-1")
    done = lake.read_curated(spark, paths.curated, hot.runs)
    places = {
        "raw_trades": lake.read_raw_trades(spark, paths.raw_trades, runs=hot.runs),
        "raw_notifications": lake.read_raw_notifications(spark, paths.raw_notifications, runs=hot.runs),
        "curated": done,
        "flagged": done.where("triggered_notification"),
        "hot_trades": hot.scan_trades(),
        "hot_notifications": hot.scan_notifications(),
    }
    counted = [
        df.groupBy("symbol").agg(F.count(F.lit(1)).alias("rows")).withColumn("place", F.lit(place))
        for place, df in places.items()
    ]
    result = counted[0]
    for more in counted[1:]:
        result = result.unionByName(more)
    return result


@query("archive_contents", TRADES + " select *, 'raw' as place from trades")
def _(spark, sf):
    """The trades themselves after three runs, as the raw archive has them."""
    hot = HotStore(spark, work_dir(spark, "hot"))
    paths = lifecycle.LakePaths(work_dir(spark, "lake"))
    trades = tape.trades(spark, sf)
    for part in range(3):
        hot.append(f"s{part}", {lifecycle.TRADES: trades.where(F.col("aggregate_id") % 3 == part)})
        lifecycle.drain(hot, paths, f"run-{part}")
    return lake.read_raw_trades(spark, paths.raw_trades, runs=hot.runs).withColumn("place", F.lit("raw"))


@query("flag_doubled_tape", FLAGGED + " select trade_id, triggered_notification from flagged")
def _(spark, sf):
    """Every trade delivered and stored twice: one copy stays, one is flagged."""
    hot = HotStore(spark, work_dir(spark, "hot"))
    trades, notices = tape.trades(spark, sf), tape.notifications(spark, sf)
    for batch in ("a", "b"):
        hot.append(batch, {lifecycle.TRADES: trades, lifecycle.NOTIFICATIONS: notices})
    once = envelopes.dedup_events(hot.scan_trades(), "trade_id")
    flagged = matching.flag_trades(once, hot.scan_notifications())
    return flagged.select("trade_id", "triggered_notification")


def _hot_tape(spark: SparkSession, sf: str) -> HotStore:
    """Trades and notifications in a hot store of several batches."""
    hot = HotStore(spark, work_dir(spark, "hot"))
    trades, notices = tape.trades(spark, sf), tape.notifications(spark, sf)
    number = F.col("trade_id").cast("bigint")
    for part in range(3):
        rows = {lifecycle.TRADES: trades, lifecycle.NOTIFICATIONS: notices}
        hot.append(f"s{part}", {t: df.where(number % 3 == part) for t, df in rows.items()})
    return hot


@query(
    "hot_trades_time_range",
    TRADES + """ select * from trades where symbol = 'CLICKUSDT'
  and trade_time >= timestamp '2024-01-05' and trade_time <= timestamp '2024-01-12'""",
)
def _(spark, sf):
    start, end = (dt.datetime(2024, 1, n, tzinfo=dt.timezone.utc) for n in (5, 12))
    wanted = TradeFilter(symbol="CLICKUSDT", trade_time=TimeRange(after=start, before=end))
    return filters.find_trades(_hot_tape(spark, sf).scan_trades(), wanted)


@query(
    "hot_trades_top",
    TRADES + " select * from trades where price > 100 order by price desc, trade_id limit 40",
)
def _(spark, sf):
    order = {"sort1": SortKey("price", "DESC"), "sort2": SortKey("trade_id", "ASC")}
    wanted = TradeFilter(price=NumericRange(gt=100), limit=40, **order)
    return filters.find_trades(_hot_tape(spark, sf).scan_trades(), wanted)


@query("hot_notifications_symbol", NOTICES + " select * from notifications where symbol = 'ERRORUSDT'")
def _(spark, sf):
    notices = _hot_tape(spark, sf).scan_notifications()
    return filters.find_notifications(notices, NotificationFilter(symbol="ERRORUSDT"))


@query("hot_id_lookup", TRADES + " select * from trades where trade_id = (select max(trade_id) from trades)")
def _(spark, sf):
    """A trade by its id, which the files answer by Bloom filter."""
    wanted = tape.trades(spark, sf).agg(F.max("trade_id")).first()[0]
    return filters.find_trades(_hot_tape(spark, sf).scan_trades(), TradeFilter(trade_id=wanted))


@query(
    "hot_merged_range",
    TRADES + " select * from trades where price > 9000 and quantity < 50 and trade_time >= timestamp '2024-01-10'",
)
def _(spark, sf):
    """Ranges of three columns on a hot store that was merged in Z-order."""
    hot = _hot_tape(spark, sf)
    lifecycle.compact(hot, lifecycle.TRADES, "merge")
    wanted = TradeFilter(
        price=NumericRange(gt=9000),
        quantity=NumericRange(lt=50),
        trade_time=TimeRange(after=dt.datetime(2024, 1, 10)),
    )
    return filters.find_trades(hot.scan_trades(), wanted)


@query(
    "hot_deletes",
    TRADES + " select * from trades where not (price * quantity > 200000) and aggregate_id % 100 <> 7",
)
def _(spark, sf):
    """A long and a short list of ids deleted from the hot store."""
    hot, trades = _hot_tape(spark, sf), tape.trades(spark, sf)
    lifecycle.delete_trades(hot, alerts.detect_alerts(trades, 200_000), "long")
    lifecycle.delete_trades(hot, trades.where("aggregate_id % 100 = 7"), "short")
    return hot.scan_trades()


@query(
    "lake_compaction",
    TRADES + f""" select 'raw' as place, symbol, trade_id as id, price, trade_time from trades
  union all select 'curated', symbol, '', price, date_trunc('millisecond', trade_time) from trades
  union all select 'rollup', symbol, cast(count(*) as varchar), max(price), date_trunc('hour', trade_time)
  from trades group by symbol, date_trunc('hour', trade_time)""",
)
def _(spark, sf):
    """Three runs over the same days, packed into one: the same rows in a third of the folders."""
    hot = HotStore(spark, work_dir(spark, "hot"))
    paths = lifecycle.LakePaths(work_dir(spark, "lake"))
    trades = tape.trades(spark, sf)
    for part in range(3):
        hot.append(f"s{part}", {lifecycle.TRADES: trades.where(F.col("aggregate_id") % 3 == part)})
        lifecycle.drain(hot, paths, f"run-{part}")
    lifecycle.compact_lake(hot.runs, paths, "2024-01-20", "packed")
    raw = lake.read_raw_trades(spark, paths.raw_trades, runs=hot.runs)
    done = lake.read_curated(spark, paths.curated, hot.runs)
    hours = lake.read_merged_rollups(spark, paths.analytics, "hourly", hot.runs)
    return (
        raw.select(F.lit("raw").alias("place"), "symbol", F.col("trade_id").alias("id"), "price", "trade_time")
        .unionByName(done.select(F.lit("curated").alias("place"), "symbol", F.lit("").alias("id"), "price", "trade_time"))
        .unionByName(
            hours.select(
                F.lit("rollup").alias("place"), "symbol", F.col("trade_count").cast("string").alias("id"),
                F.col("max_price").alias("price"), F.col("hour_start").alias("trade_time"),
            )
        )
    )


@query("curated_file_order", FLAGGED + """ select symbol, strftime(trade_time, '%Y-%m-%d') as date, count(*) as rows,
  true as in_order from flagged group by 1, 2""")
def _(spark, sf):
    """Whether each file of the curated trades is in the order of trade time."""
    path = work_dir(spark, "curated")
    lake.write_curated(curate.curated(curate.processed(_flagged(spark, sf))), path, "run-1")
    rows = lake.curated_rows(spark, path).select("symbol", "date", "trade_time", "_metadata.file_path", "_metadata.row_index")
    before = F.lag("trade_time").over(Window.partitionBy("file_path").orderBy("row_index"))
    ordered = rows.withColumn("ordered", F.coalesce(before <= F.col("trade_time"), F.lit(True)))
    return ordered.groupBy("symbol", "date").agg(F.count("*").alias("rows"), F.every("ordered").alias("in_order"))


_DEAR = "with " + _trades_sql() + ", flagged as (select *, false as triggered_notification from trades where price > 20000)"


@query(
    "empty_buckets",
    _DEAR + """ select s.symbol, cast(h.hour_start as timestamp) as hour_start
  from (select distinct symbol from flagged) s,
       (select unnest(generate_series(date_trunc('hour', lo), date_trunc('hour', hi), interval 1 hour)) as hour_start
        from (select min(trade_time) as lo, max(trade_time) as hi from flagged)) h
  where not exists (select 1 from flagged f where f.symbol = s.symbol and date_trunc('hour', f.trade_time) = h.hour_start)""",
)
def _(spark, sf):
    """Hours of a symbol between the first and the last trade that have no row in the rollup."""
    dear = tape.trades(spark, sf).where("price > 20000").withColumn("triggered_notification", F.lit(False))
    hours = rollup.rollup(dear, "hourly").select("symbol", "hour_start")
    first, last = hours.agg(F.min("hour_start"), F.max("hour_start")).first()
    if first is None:
        return hours
    span = F.sequence(F.lit(first), F.lit(last), F.expr("interval 1 hour"))
    every = hours.select("symbol").distinct().select("symbol", F.explode(span).alias("hour_start"))
    return every.join(hours, ["symbol", "hour_start"], "left_anti")


@query("upload_rollups", FLAGGED + _rollup_sql("hourly"))
def _(spark, sf):
    """Rollups through a data source writer over the caller's uploader, and read back."""
    base = work_dir(spark, "uploads")
    name = upload.register(spark, upload.FolderUploader(base), "tape_upload")
    rows = _rounded(rollup.rollup(_flagged(spark, sf), "hourly"))
    upload.upload(rows, name, "hourly", "run-1", maxRecordsPerFile="500")
    return upload.read_uploaded(spark, base, "hourly", schemas.rollup("hourly"))


# --- streaming -------------------------------------------------------------------------


def _event_stream(spark: SparkSession, sf: str) -> DataFrame:
    schema = tape.events(spark, sf).schema
    # A plain stream path must be a folder; a pattern also takes a table that is one file.
    return spark.readStream.schema(schema).parquet(f"{sf}/events.parque[t]")


@query("stream_fan_out", _COPIES)
def _(spark, sf):
    sent = envelopes.wrap_trades(tape.trades_from(_event_stream(spark, sf)), F.lit("-"))
    notices = envelopes.wrap_notifications(
        alerts.build_notifications(tape.trades_from(_event_stream(spark, sf))), F.lit("-")
    )
    out = work_dir(spark, "fan-out")

    def receive(subscriber: str):
        def write(events: DataFrame, batch: int) -> None:
            events.select("type", "id").write.mode("overwrite").parquet(
                f"{out}/subscriber={subscriber}/batch={batch}"
            )

        return write

    handlers = {
        s: receive(s) for s in (schemas.STORE_SUBSCRIBER, schemas.ALERT_SUBSCRIBER)
    }
    wire = envelopes.to_wire(sent.unionByName(notices))
    ingest.start_fan_out(wire, handlers, work_dir(spark, "checkpoint")).awaitTermination()
    return spark.read.parquet(out).select("subscriber", "type", "id")


@query("stream_append_hot", NOTICES + " select 'BinanceTradeEvent' as type, trade_id from trades union all select 'NotificationEvent', trade_id from notifications")
def _(spark, sf):
    trades = tape.trades_from(_event_stream(spark, sf))
    sent = envelopes.wrap_trades(trades, F.lit("-")).unionByName(
        envelopes.wrap_notifications(alerts.build_notifications(trades), F.lit("-"))
    )
    out = work_dir(spark, "hot")
    ingest.start_hot_append(sent, out, work_dir(spark, "checkpoint")).awaitTermination()
    stored = spark.read.parquet(out)
    field = F.when(F.col("type") == schemas.TRADE_EVENT, F.get_json_object("event_data", "$.ID"))
    return stored.select(
        "type", F.coalesce(field, F.get_json_object("event_data", "$.TradeID")).alias("trade_id")
    )


_INGESTED = (
    TRADES.replace("cast(event_id as varchar) as trade_id", "sha256(lower(event_type) || 'usdt@aggTrade#' || event_id) as trade_id")
    + _NOTIFICATIONS
)


def _ingest(spark: SparkSession, sf: str) -> tuple[HotStore, str]:
    source = frames.encode_frames(tape.trades_from(_event_stream(spark, sf)))
    hot = HotStore(spark, work_dir(spark, "hot"))
    out = work_dir(spark, "alerts")
    ingest.start_ingest(
        source, hot, work_dir(spark, "checkpoint"), ingest.alert_table(out)
    ).awaitTermination()
    return hot, out


@query(
    "stream_alerts",
    _INGESTED + f" select trade_id, {_MESSAGE} as message from trades where price * quantity > 2000000",
)
def _(spark, sf):
    _, out = _ingest(spark, sf)
    return spark.read.parquet(out).select("trade_id", "message")


@query("stream_two_sources", _INGESTED + """ select 'trade' as what, trade_id from trades
  union all select 'alert', trade_id from trades where price * quantity > 2000000""")
def _(spark, sf):
    """Two feeds into one hot store and one alert folder, the second on a checkpoint of its own."""
    hot, out = HotStore(spark, work_dir(spark, "hot")), work_dir(spark, "alerts")
    for part in (0, 1):
        events = _event_stream(spark, sf).where(F.col("event_id") % 2 == part)
        source = frames.encode_frames(tape.trades_from(events))
        ingest.start_ingest(
            source, hot, work_dir(spark, "checkpoint"), ingest.alert_table(out)
        ).awaitTermination()
    alerted = spark.read.parquet(out).select(F.lit("alert").alias("what"), "trade_id")
    return hot.scan_trades().select(F.lit("trade").alias("what"), "trade_id").unionByName(alerted)


@query(
    "concurrent_ingest_and_drain",
    _INGESTED + " select trade_id, symbol, price, quantity, date_trunc('millisecond', trade_time) as trade_time from trades",
)
def _(spark, sf):
    """Feeds arrive while the store is drained: lake and store hold each trade once."""
    hot = HotStore(spark, work_dir(spark, "hot"))
    paths, out = lifecycle.LakePaths(work_dir(spark, "lake")), work_dir(spark, "alerts")

    def feed(part: int) -> None:
        events = _event_stream(spark, sf).where(F.col("event_id") % 3 == part)
        source = frames.encode_frames(tape.trades_from(events))
        ingest.start_ingest(
            source, hot, work_dir(spark, "checkpoint"), ingest.alert_table(out)
        ).awaitTermination()

    feed(0)
    with ThreadPoolExecutor(2) as pool:
        others = [pool.submit(feed, part) for part in (1, 2)]
        lifecycle.drain(hot, paths)
        for other in others:
            other.result()
    archived = lake.read_raw_trades(spark, paths.raw_trades, runs=hot.runs)
    both = archived.unionByName(hot.scan_trades())
    return both.select("trade_id", "symbol", "price", "quantity", "trade_time")


@query("stream_notifications", _INGESTED + " select * from notifications")
def _(spark, sf):
    hot, _ = _ingest(spark, sf)
    return hot.scan_notifications()


@query(
    "stream_envelopes",
    NOTICES
    + """ select sha256('BinanceTradeEvent#' || trade_id) as id, 'BinanceTradeEvent' as type, 'then' as created_at,
    'WebSocketStreamServer' as source, 'consumer.mongo,consumer.telegrambot' as subscribers, price from trades
  union all select sha256('NotificationEvent#' || trade_id), 'NotificationEvent', 'then', 'TelegramBot',
    'consumer.mongo', price from notifications""",
)
def _(spark, sf):
    """Envelopes fanned out to the hot store, and what it holds of them."""
    trades = tape.trades_from(_event_stream(spark, sf))
    sent = envelopes.wrap_trades(trades, F.lit("then")).unionByName(
        envelopes.wrap_notifications(alerts.build_notifications(trades), F.lit("then"))
    )
    hot = HotStore(spark, work_dir(spark, "hot"))
    handlers = {schemas.STORE_SUBSCRIBER: ingest.hot_handler(hot)}
    ingest.start_fan_out(envelopes.to_wire(sent), handlers, work_dir(spark, "checkpoint")).awaitTermination()
    both = hot.scan_envelopes(lifecycle.TRADES).unionByName(hot.scan_envelopes(lifecycle.NOTIFICATIONS))
    return both.select(
        "id", "type", "created_at", "source", F.concat_ws(",", "subscribers").alias("subscribers"),
        F.get_json_object("event_data", "$.Price").cast("double").alias("price"),
    )


@query("stream_redelivery", _COPIES.replace("select subscriber, type, id from copies", "select subscriber, type, id, 1 as runs from copies"))
def _(spark, sf):
    """One of two handlers fails at first; when the batch is repeated the other does not run again."""
    trades = tape.trades_from(_event_stream(spark, sf))
    sent = envelopes.wrap_trades(trades, F.lit("-")).unionByName(
        envelopes.wrap_notifications(alerts.build_notifications(trades), F.lit("-"))
    )
    out, checkpoint = work_dir(spark, "deliveries"), work_dir(spark, "checkpoint")
    away = {schemas.ALERT_SUBSCRIBER}

    def receive(subscriber: str):
        def write(events: DataFrame, batch: str) -> None:
            if subscriber in away:
                away.clear()
                raise OSError("no connection")
            events.select("type", "id").write.mode("append").parquet(f"{out}/subscriber={subscriber}")

        return write

    handlers = {s: receive(s) for s in (schemas.STORE_SUBSCRIBER, schemas.ALERT_SUBSCRIBER)}
    for _ in range(2):
        try:
            ingest.start_fan_out(envelopes.to_wire(sent), handlers, checkpoint).awaitTermination()
        except StreamingQueryException:
            pass
    seen = spark.read.parquet(out).groupBy("subscriber", "type", "id")
    return seen.agg(F.count("*").cast("int").alias("runs"))


@query("stream_frames", _INGESTED + " select trade_id, symbol, price, quantity from trades")
def _(spark, sf):
    """Frame files pulled a few at a time into the hot store."""
    folder = work_dir(spark, "frames")
    frames.encode_frames(tape.trades(spark, sf)).repartition(4).write.text(folder)
    source = frames.read_frames(spark, folder, streaming=True, maxFilesPerTrigger="1")
    hot = HotStore(spark, work_dir(spark, "hot"))
    sink = ingest.alert_table(work_dir(spark, "alerts"))
    ingest.start_ingest(source, hot, work_dir(spark, "checkpoint"), sink).awaitTermination()
    return hot.scan_trades().select("trade_id", "symbol", "price", "quantity")


@query("periodic_drain", TRADES + " select * from trades")
def _(spark, sf):
    """What a periodic drain has brought to the lake."""
    hot, paths = _hot_tape(spark, sf), lifecycle.LakePaths(work_dir(spark, "lake"))
    lifecycle.drain_periodically(hot, paths, work_dir(spark, "checkpoint")).awaitTermination()
    return lake.read_raw_trades(spark, paths.raw_trades, runs=hot.runs)


@query(
    "stream_upload_alerts",
    TRADES + f" select trade_id, {_MESSAGE} as message from trades where price * quantity > 2000000",
)
def _(spark, sf):
    """Alerts of a stream through a data source writer over the caller's uploader."""
    base = work_dir(spark, "uploads")
    name = upload.register(spark, upload.FolderUploader(base), "alert_upload")
    found = alerts.alert_messages(tape.trades_from(_event_stream(spark, sf))).select("trade_id", "message")
    writer = found.writeStream.format(name).option("table", "alerts")
    writer = writer.option("checkpointLocation", work_dir(spark, "checkpoint"))
    writer.trigger(availableNow=True).start().awaitTermination()
    return upload.read_uploaded(spark, base, "alerts", found.schema)


@query("stream_late_rollup", "with " + _trades_sql() + ", flagged as (select *, false as triggered_notification from trades)" + _rollup_sql("hourly"))
def _(spark, sf):
    """Trades far later than the latest one still count: batches that each span all days."""
    folder = work_dir(spark, "events")
    tape.events(spark, sf).repartition(4, "event_id").write.parquet(folder)
    events = spark.readStream.schema(tape.events(spark, sf).schema).option("maxFilesPerTrigger", "1").parquet(folder)
    out = work_dir(spark, "states")
    live.start_state_stream(tape.trades_from(events), out, work_dir(spark, "checkpoint")).awaitTermination()
    return _rounded(lake.read_merged_rollups(spark, out, "hourly"))


@query("stream_dedup", TRADES + " select trade_id, symbol from trades")
def _(spark, sf):
    """Every event delivered twice."""
    trades = tape.trades_from(_event_stream(spark, sf))
    twice = trades.withColumn("delivery", F.explode(F.array(F.lit(1), F.lit(2))))
    once = ingest.dedup_stream(twice, "trade_id", "trade_time", "1 hour")
    out = work_dir(spark, "dedup")
    writer = once.select("trade_id", "symbol").writeStream.format("parquet").option("path", out)
    writer = writer.option("checkpointLocation", work_dir(spark, "checkpoint"))
    writer.trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(out)


@query(
    "stream_rollup",
    TRADES
    + ", flagged as (select *, false as triggered_notification from trades), rolled as ("
    + _rollup_sql("hourly")
    + """) select * from rolled where hour_start + interval 1 hour
  <= (select max(date_trunc('millisecond', trade_time)) - interval 10 minutes from trades)""",
)
def _(spark, sf):
    """Hours the watermark has closed at the end of input."""
    rolled = live.stream_rollup(tape.trades_from(_event_stream(spark, sf)), "hourly", "10 minutes")
    out = work_dir(spark, "stream-rollup")
    live.start_stream_rollup(rolled, out, work_dir(spark, "checkpoint")).awaitTermination()
    return _rounded(spark.read.parquet(out))

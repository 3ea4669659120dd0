"""Filters, sort, limit, alerts."""

from __future__ import annotations

import datetime as dt

import pytest

from tapeloom.operators import alerts, filters
from tapeloom.operators.filters import NotificationFilter, NumericRange, SortKey, TimeRange, TradeFilter

from helpers import at, notice, notices, rows, trade, trades


@pytest.fixture(scope="module")
def tape(spark):
    return trades(
        spark,
        [
            trade(1, price=1.0, is_buyer_maker=True),
            trade(2, price=2.0, symbol="BBBUSDT", event_type="other"),
            trade(3, price=3.0, stream="cccusdt@aggTrade", event_time=at(0.5)),
            trade(4, price=None, event_time=at(5)),
        ],
    ).cache()


def ids(df):
    return [r[0] for r in df.select("aggregate_id").collect()]


@pytest.mark.parametrize(
    ("f", "want"),
    [
        (TradeFilter(), [1, 2, 3, 4]),
        (TradeFilter(symbol="BBBUSDT"), [2]),
        (TradeFilter(symbol="BBBUSDT", is_buyer_maker=True), []),
        (TradeFilter(is_buyer_maker=False), [2, 3, 4]),
        (TradeFilter(aggregate_id=3), [3]),
        (TradeFilter(price=NumericRange(eq=2.0)), [2]),
        (TradeFilter(price=NumericRange(gt=1.0, lte=3.0)), [2, 3]),
        (TradeFilter(price=NumericRange(gte=1.0, lt=3.0, ne=1.0)), [2]),
        # A missing value counts as different.
        (TradeFilter(price=NumericRange(ne=2.0)), [1, 3, 4]),
        (TradeFilter(event_time=TimeRange(dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1))), [1, 2]),
        (TradeFilter(event_time=TimeRange(after=at(0.5))), [3, 4]),
        (TradeFilter(event_time=TimeRange(before=at(0.5))), [1, 2, 3]),
        (TradeFilter(regex="CCC"), [3]),
        (TradeFilter(regex="^bbb|OTHER"), [2]),
        (TradeFilter(regex=""), [1, 2, 3, 4]),
        (TradeFilter(limit=0), [1, 2, 3, 4]),
    ],
)
def test_trade_filter(tape, f, want):
    assert sorted(ids(filters.find_trades(tape, f))) == want


@pytest.mark.parametrize(
    ("f", "want"),
    [
        (TradeFilter(sort1=SortKey("price", "DESC")), [3, 2, 1, 4]),
        (TradeFilter(sort1=SortKey("price", "ASC")), [4, 1, 2, 3]),
        (TradeFilter(sort1=SortKey(None, "DESC"), sort2=SortKey("price", "DESC"), limit=2), [3, 2]),
        (TradeFilter(sort1=SortKey("symbol", "DESC"), sort2=SortKey("price", "DESC")), [2, 3, 1, 4]),
        (TradeFilter(sort1=SortKey("price", "DESC"), limit=-3), [3, 2, 1]),
    ],
)
def test_order_and_limit(tape, f, want):
    assert ids(filters.find_trades(tape, f)) == want


def test_whole_second_sorts_before_its_fraction(tape):
    f = TradeFilter(sort1=SortKey("event_time", "ASC"), limit=3)
    assert ids(filters.find_trades(tape, f)) == [1, 2, 3]


def test_unknown_names_are_refused(tape):
    with pytest.raises(ValueError, match="sort field"):
        filters.find_trades(tape, TradeFilter(sort1=SortKey("nope", "ASC")))
    for given in ({"Nope": 1}, {"Price": {"above": 1}}, {"SortField1": "Nope", "SortDir1": "ASC"}):
        with pytest.raises(ValueError, match="unknown"):
            filters.trade_filter(given)
    with pytest.raises(ValueError, match="unknown"):
        filters.notification_filter({"TradeID": "x"})


def test_wire_filter():
    f = filters.trade_filter(
        {"Symbol": "A", "Price": {"gt": 1.0, "ne": None}, "TradeTime": {"after": at(1)}, "Limit": 5,
         "SortField1": "TradeTime", "SortDir1": "DESC", "Regex": None}
    )
    assert f == TradeFilter(
        symbol="A",
        price=NumericRange(gt=1.0),
        trade_time=TimeRange(after=at(1)),
        limit=5,
        sort1=SortKey("trade_time", "DESC"),
    )
    assert filters.trade_filter(None) == TradeFilter()
    n = filters.notification_filter({"TotalPrice": {"lte": 3.0}, "EventTime": "e"})
    assert n == NotificationFilter(event_time="e", total_price=NumericRange(lte=3.0))


def test_projection(tape):
    assert filters.find_trades(tape, TradeFilter(aggregate_id=1), ["price"]).columns == ["price"]


def test_notification_filter(spark):
    df = notices(
        spark,
        [
            notice("e1", trade_id="a", total_price=1.0),
            notice("e2", trade_id="b", total_price=2.0, symbol="BBBUSDT"),
            notice("e3", trade_id="c", total_price=3.0),
        ],
    )

    def found(f, **kw):
        return [r[0] for r in rows(filters.find_notifications(df, f, **kw), "trade_id")]

    assert found(NotificationFilter(event_time="e1")) == ["a"]
    assert found(NotificationFilter(total_price=NumericRange(gte=2.0))) == ["b", "c"]
    assert found(NotificationFilter(regex="E3|bbb")) == ["b", "c"]
    assert found(NotificationFilter(trade_id="a")) == ["a"]
    # The list wins over the single id, as literals or as a table.
    assert found(NotificationFilter(trade_id="a", trade_ids=("b", "c"))) == ["b", "c"]
    many = tuple(f"x{i}" for i in range(filters.LITERAL_LIST)) + ("c",)
    assert found(NotificationFilter(trade_id="a", trade_ids=many)) == ["c"]
    table = spark.createDataFrame([("b",), ("b",)], "trade_id string")
    assert found(NotificationFilter(trade_id="a"), trade_ids=table) == ["b"]
    assert "trade_id" not in filters.public_notifications(df).columns


def test_has_more(spark, tape):
    assert filters.has_more(tape).first()[0] is True
    assert filters.has_more(tape.where("false")).first()[0] is False


def test_oldest(tape):
    assert ids(filters.oldest(tape, 2)) == [1, 2]


def test_oldest_across_hours_seconds_and_ties(spark):
    times = [None, at(0), at(0), at(0), at(0.5), at(0.5), at(1), at(3599), at(3600), at(3600), at(9000)]
    made = [trade(n, trade_time=t) for n, t in enumerate(times)]
    df = trades(spark, made[::-1])
    for n in (0, 1, 3, 5, 6, 8, 9, 11, 20):
        assert sorted(r.aggregate_id for r in filters.oldest(df, n).collect()) == list(range(min(n, len(made))))


def test_alerts(spark):
    df = trades(
        spark,
        [
            trade(1, price=2_000_000.0, quantity=1.0),
            trade(2, price=1_000_000.0, quantity=2.5, event_time=at(0.12), is_buyer_maker=True),
        ],
    )
    assert ids(alerts.detect_alerts(df)) == [2]
    assert ids(alerts.detect_alerts(df, threshold=1_999_999)) == [1, 2]
    assert rows(alerts.build_notifications(df)) == [
        ("2024-01-01T00:00:00.12Z", 1_000_000.0, 2.5, "AAAUSDT", True, 2_500_000.0, "t0002")
    ]
    assert rows(alerts.alert_messages(df)) == [
        (
            "t0002",
            "🚨 *Trade Alert!*\nSymbol: AAAUSDT\nPrice: 1000000.000000\nQty: 2.500000\n"
            "TotalPrice: 2 500 000.00",
        )
    ]


def test_top_k_plan(tape, spark, tmp_path):
    tape.write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    f = TradeFilter(symbol="AAAUSDT", price=NumericRange(gt=1.0), sort1=SortKey("price", "DESC"), limit=5)
    plan = filters.find_trades(stored, f, ["price"])._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
    assert "PushedFilters: [IsNotNull(symbol), IsNotNull(price), EqualTo(symbol,AAAUSDT), GreaterThan(price,1.0)]" in plan
    assert "ReadSchema: struct<trade_id:string,symbol:string,price:double>" in plan

"""The patterns' dialect against Python's engine, and the literals taken out of them."""

from __future__ import annotations

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tapeloom.functions import patterns
from tapeloom.operators import filters
from tapeloom.operators.filters import TradeFilter
from tapeloom.session import session_conf

from helpers import trade, trades

TEXTS = [
    "", "BTCUSDT", "btcusdt@aggTrade", "ethbtc", "a&b", "a&&b", "x[1]", "k]", "\u212aelvin", "KELVIN", "2024-01-09T09:00:00Z",
    "line one\nline two", "end\n", "carriage\rreturn", "a.b", "aab", "ab", "aaa", "Stra\u017fe", "STRASSE", "tab\there", "a_b-c",
    "\u00c9t\u00e9", "\u00e9t\u00e9", "digit9", "(paren)", "c|d",
]
# Python reads these as the Perl-like library does.
PATTERNS = [
    "btc", "^btc", "usdt$", "btc|eth", "^(cli|ERR)", "-01-0", "-01-1|view", "a.b", r"a\.b", "[a&&b]", "a[&]b", "x[[]1", "k[]]",
    "[^a-z@]", "a+b", "a*b", "a?b", "a{2}b", "a{2,3}", "(?P<w>a)(?P=w)", "(?P<my_name>b)tc", r"\d{4}-\d{2}", r"\bone\b", "one$", "end$",
    "carriage.return", "line one.line", "kelvin", "stra", "\u00e9t\u00e9", r"\(paren\)", r"c\|d", "(a|b)b", "(?:ab|aab)", r"\ttab|\t", "[\\w-]+c",
    "a(?=a)", "(?<!a)b", "", "^$", "T09:|@agg", "usd.@", "x\\[1\\]",
]


def found(df, pattern):
    for condition in patterns.any_matches([F.col("t")], pattern):
        df = df.where(condition)
    return {r[0] for r in df.collect()}


def test_same_as_the_perl_like_dialect(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    for pattern in PATTERNS:
        got = found(df, pattern)
        want = {t for t in TEXTS if re.search(pattern, t, re.IGNORECASE)}
        assert got == want, pattern


def test_posix_classes_and_quotes(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "t string")

    assert found(df, "[[:digit:]]$") == {t for t in TEXTS if re.search("[0-9]$", t)}
    assert found(df, "^[[:alpha:]_]+-c") == {"a_b-c"}
    assert found(df, "[^[:^space:]]") == {t for t in TEXTS if re.search(r"\s", t)}
    assert found(df, r"\Qx[1\E") == {"x[1]"}


@pytest.mark.parametrize("pattern", [r"a\Kb", "(?R)", "(a)(?1)", "(?(1)a|b)", "(?|a|b)", "(*FAIL)", r"\Ca", r"(a)\g{-1}", "[a", "[[:nope:]]"])
def test_what_java_reads_otherwise_is_refused(pattern):
    with pytest.raises(patterns.UnsupportedPattern):
        patterns.translated(pattern)


def test_literals():
    assert patterns.literals("^btcu") == ["btcu"]
    assert patterns.literals("btc|eth") == ["btc", "eth"]
    assert patterns.literals("ab?cd") == ["a", "cd"][1:]
    assert patterns.literals("(btc|eth)usdt") == ["usdt"]
    assert patterns.literals("a+") is None
    assert patterns.literals("btc|.*") is None
    assert patterns.literals("(?-i)btc") is None
    assert patterns.literals(r"\x41bc") is None
    assert sorted(patterns.variants("a1")) == ["A1", "a1"]
    assert "\u212a" in patterns.variants("k")


@settings(max_examples=300, deadline=None)
@given(st.text("ab1|()[]^$.*+?\\\\{}-", max_size=8), st.text("abAB1-", max_size=6))
def test_a_match_holds_a_literal(pattern, text):
    try:
        compiled = re.compile(pattern, re.IGNORECASE)
        known = patterns.literals(pattern)
    except (re.error, patterns.UnsupportedPattern):
        return
    if known and compiled.search(text):
        assert any(k.lower() in text.lower() for k in known)
        assert any(v in text for k in known for v in patterns.variants(k))


def test_literal_is_pushed_to_the_scan(spark, tmp_path):
    trades(spark, [trade(1), trade(2, symbol="BTCUSDT")]).write.parquet(str(tmp_path / "t"))
    df = filters.find_trades(spark.read.parquet(str(tmp_path / "t")), TradeFilter(regex="^btc"))
    with session_conf(spark, {"spark.sql.maxMetadataStringLength": "10000"}):
        plan = df._jdf.queryExecution().executedPlan().toString()
    assert "StringContains(symbol,BTC)" in plan.split("PushedFilters")[1]
    assert [r.symbol for r in df.collect()] == ["BTCUSDT"]

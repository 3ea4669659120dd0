"""Sums that do not depend on the order of rows, partitions or runs."""

from __future__ import annotations

import math
import random
from fractions import Fraction
from functools import reduce
from operator import add

import pytest
from pyspark.sql import functions as F

from tapeloom.functions import exactsum
from tapeloom.operators import rollup

from helpers import at, rows, trade, trades


def total(df):
    return df.agg(*exactsum.sums("x", "x")).select(exactsum.total("x")).first()[0]


def made(n=300):
    random.seed(1)
    values = [0.1, 1e16, 0.1, -0.3, 1e-9, 123456.789, 2.0**60, -(2.0**60), 1 / 3, 5e-324, -0.0]
    return [random.choice(values) for _ in range(n)]


@pytest.mark.parametrize("values", [[0.1] * 10, [1e16, 0.1, 0.1], [-0.1], [-0.1] * 7 + [0.5], [0.0], [2.0**70, 1.5], [1e9] * 50 + [1e-3]])
def test_is_the_rounded_exact_sum(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    exact = float(sum(Fraction(v) for v in values))
    assert math.isclose(total(df), exact, rel_tol=2e-16, abs_tol=1e-16)


def test_ten_tenths_are_one(spark):
    assert total(spark.createDataFrame([(0.1,)] * 10, "x double")) == 1.0


def test_same_bits_in_any_order(spark):
    values = made()
    df = spark.createDataFrame([(v,) for v in values], "x double")
    found = {total(df.repartition(n)).hex() for n in (1, 7, 200)}
    random.shuffle(values)
    found.add(total(spark.createDataFrame([(v,) for v in values], "x double")).hex())
    assert len(found) == 1
    # The plain sum is not like that.
    assert len({reduce(add, random.sample(values, len(values))).hex() for _ in range(20)}) > 1


def test_far_missing_and_odd_values(spark):
    def of(*values):
        return total(spark.createDataFrame([(v,) for v in values], "x double"))

    assert of(1e300, 1.0) == 1e300
    assert of(float("inf"), 1.0) == math.inf
    assert math.isnan(of(float("nan"), 1.0))
    assert of(None, 2.5, None) == 2.5
    assert of(None) == 0.0


def test_merging_keeps_limbs_small(spark):
    df = spark.createDataFrame([(n, 0.7) for n in range(1000)], "n int, x double")
    parts = df.groupBy((F.col("n") % 9).alias("g")).agg(*exactsum.sums("x", "x")).select("g", *exactsum.carried("x"))
    assert parts.where("x_0 < 0 or x_0 >= 4294967296 or x_1 < 0 or x_1 >= 4294967296").count() == 0
    whole = parts.agg(*exactsum.merged("x")).select(exactsum.total("x")).first()[0]
    assert whole == total(df)


def test_rollups_and_merged_runs_have_the_same_bits(spark):
    """1e16 and 0.1 in one minute, in any partitioning and any order of runs."""
    values = [1e16, 0.1, 0.1, 0.7, 1e16, 0.3] * 5
    tape = [trade(n, price=v, quantity=values[-n], trade_time=at(n)) for n, v in enumerate(values)]
    df = trades(spark, tape).withColumn("triggered_notification", F.lit(False))
    seen = {
        tuple(x.hex() for x in rollup.rollup(df.repartition(n), grain).select("avg_price", "volume").first())
        for n in (1, 7, 200)
        for grain in rollup.GRAINS
    }
    assert len(seen) == 1
    states = [rollup.minute_state(df.where(F.col("aggregate_id") % 3 == k)) for k in range(3)]
    for order in ((0, 1, 2), (2, 0, 1), (1, 2, 0)):
        merged = rollup.merge_states([states[k] for k in order])
        assert rows(rollup.publish(merged, "daily")) == rows(rollup.rollup(df, "daily"))


def test_hash_aggregate_stays(spark):
    df = trades(spark, [trade(1)]).withColumn("triggered_notification", F.lit(False))
    plan = rollup.rollup(df, "hourly")._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan

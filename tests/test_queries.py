from datetime import datetime

from conftest import SMALL
from pyspark.sql import functions as F

from __spark_entry__ import entry, oracle_sql, queries
from barworks.functions.schema import KEYS
from barworks.operators import fills, indicators, quality
from barworks.operators.positions import number_rows
from barworks.plans import catalog, training
from barworks.plans.catalog import ORACLES, QUERIES
from barworks.sources import store


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["pair", "timeframe", "split", "seq_no", "sequence", "target"]
    assert df.count() == 4051


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())
    assert set(ORACLES) == set(QUERIES)


def test_no_join_multiplies_rows(spark):
    plan = queries()["training_set"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan and "SinglePartition" not in plan


def test_one_series_spreads_over_tasks(spark, bars, layout):
    """As on large data: no broadcast, no coalescing. No task may end up with most of the only series."""
    usual = {"spark.sql.adaptive.coalescePartitions.enabled": "true", "spark.sql.shuffle.partitions": "2",
             "spark.sql.autoBroadcastJoinThreshold": "10485760"}
    for name, value in zip(usual, ("false", "6", "-1")):
        spark.conf.set(name, value)
    try:
        df = bars(range(300))
        plans = {"RSI_3": indicators.rsi(df, 3, fill=False), "close": fills.interpolate_linear(df),
                 "target": training.training_set(df, {"RSI": {"period": 3}}, 5)}
        for column, plan in plans.items():
            rows = plan.groupBy(F.spark_partition_id()).agg(F.count(column).alias("m"), F.max(column)).collect()
            assert len(rows) >= 3 and max(r.m for r in rows) < 200, column
    finally:
        for name, value in usual.items():
            spark.conf.set(name, value)


def test_bars_without_a_time_spread_over_buckets(spark, bars, layout):
    df = number_rows(bars([float(i) for i in range(500)], at=[None] * 500))
    found = df.groupBy("_b").count().collect()
    assert len(found) > 100 and max(r["count"] for r in found) < 20
    assert sorted(r.rn for r in df.collect()) == list(range(500))


def test_far_apart_arrival_numbers_fill_buckets(spark, bars, layout):
    df = bars(range(70)).selectExpr("*", "cast(close * 1000000007 AS bigint) AS ingest_seq")
    assert quality._arrival_buckets(df, "ingest_seq", KEYS).select("_a").distinct().count() == 10
    assert quality.monotonic_check(df).first().n_backward == 0


def test_hot_copies_shrink_before_the_shuffle(bars):
    one = bars([1.0] * 50, at=[datetime(2024, 1, 1)] * 50)
    merged = store.merge_bars(one, one)
    assert "WindowGroupLimit" in merged._jdf.queryExecution().executedPlan().toString()
    assert merged.count() == 1


def test_legacy_files_hold_every_pair(spark, monkeypatch):
    made = catalog.view

    def more(*given):
        bars = made(*given)
        return bars.unionByName(bars.where("pair = 'view'").withColumn("pair", F.lit("other")))
    monkeypatch.setattr(catalog, "view", more)
    got = {r.pair: r["count"] for r in queries()["legacy_files"](spark, SMALL).groupBy("pair").count().collect()}
    assert got == {r.pair: r["count"] for r in more(spark, SMALL, "bars_hour").groupBy("pair").count().collect()}
    assert got["other"] == got["view"] > 0

from datetime import datetime, timedelta

import pytest

from barworks.operators import quality, rows
from barworks.sources import candles

T0 = datetime(2024, 1, 1)


def one(df):
    return df.first().asDict()


def test_steps_at_the_limits(bars, layout):
    minutes = [0, 60, 150, 241, 300]
    df = bars(range(5), at=[T0 + timedelta(minutes=m) for m in minutes])
    found = [(r.timestamp, r.gap_minutes) for r in quality.gaps(df).collect()]
    assert found == [(T0 + timedelta(minutes=241), 91.0)]
    seconds = [0, 3636, 3636 + 3564, 3636 + 3564 + 3637]
    df = bars(range(4), at=[T0 + timedelta(seconds=s) for s in seconds])
    assert one(quality.interval_check(df))["n_invalid"] == 1


def test_timestamp_report_order_of_failures(bars, layout):
    at = [T0 + timedelta(hours=h) for h in (0, 1, 1, 2)]
    df = bars(range(4), at=at).selectExpr("*", "cast(close AS bigint) AS ingest_seq")
    assert one(quality.timestamp_report(df, "2025-01-01"))["message"] == "Found 1 duplicate timestamps"
    late = bars(range(3)).selectExpr("*", "cast(close AS bigint) AS ingest_seq")
    assert one(quality.timestamp_report(late, "2024-01-01 01:30:00"))["message"] == "Found 1 timestamps in the future"
    back = late.selectExpr("* EXCEPT (ingest_seq)", "-ingest_seq AS ingest_seq")
    report = one(quality.timestamp_report(back, "2025-01-01"))
    assert report["n_backward"] == 2 and not report["valid"]
    assert one(quality.timestamp_report(late, "2025-01-01"))["valid"]


def test_unknown_timeframe_is_reported(bars, spark):
    df = bars([1, 2], timeframe="7h").unionByName(bars([1, 2]))
    found = {r.timeframe: (r.valid, r.message) for r in quality.interval_check(df).collect()}
    assert found == {"7h": (False, "Invalid timeframe: 7h"), "1h": (True, "")}
    assert quality.gaps(df).count() == 0 and quality.timestamp_report(df.selectExpr("*", "1 AS ingest_seq"), "2025-01-01").count() == 2
    with pytest.raises(Exception, match="unknown timeframe"):
        candles.plan_chunks(spark.createDataFrame([("A/B", "7h", T0, T0 + timedelta(days=1))],
                                                  "pair string, timeframe string, start timestamp, end timestamp")).collect()


def test_consistency_names_first_five(bars):
    df = bars(range(10), high=[-9.0] * 10)
    report = one(rows.consistency_report(df))
    assert report["n_high_below_low"] == 10 and not report["valid"]
    first = report["message"].split("; ")[0]
    assert first.startswith("High < Low at: 2024-01-01 00:00:00") and first.count(",") == 4
    assert one(rows.consistency_report(bars(range(1, 4))))["valid"]


def test_quality_report_stops_at_the_first_failure(bars):
    many = one(quality.quality_report(bars([None] * 3 + [1.0, 9.0], volume=[0.0] * 5)))
    assert many["error"] == "Too many missing values"
    flat = one(quality.quality_report(bars(range(9), volume=[1.0] * 9)))
    assert flat["error"] == "Low variance detected"
    bad = one(quality.quality_report(bars(range(9), volume=[-float(v) for v in range(9)])))
    assert bad["error"] == "Data consistency issues found"


def test_single_row_is_not_low_variance(bars):
    assert one(quality.low_variance(bars([1.0])))["valid"]


def test_outliers(bars):
    values = [1.0, 2.0] * 30 + [500.0]
    report = one(quality.outlier_counts(bars(values), ["close", "volume"]))
    assert report["outliers_close"] == 1 and report["outliers_volume"] == 0


def test_nan_report_warns_on_other_columns(bars):
    df = bars(range(10)).selectExpr("*", "if(close < 3, null, close) AS RSI_14")
    report = one(quality.nan_report(df))
    assert report["valid"] and report["warnings"] == ["RSI_14"]
    report = one(quality.nan_report(bars([None, None] + list(range(8)))))
    assert report["failed_column"] == "close"


def test_structure_check(bars):
    df = bars([1.0])
    assert quality.structure_check(df)[0]
    assert "volume" in quality.structure_check(df.drop("volume"))[1]
    assert "close" in quality.structure_check(df.selectExpr("* EXCEPT (close)", "'x' AS close"))[1]
    assert not quality.structure_check(df.where("false"))[0]


def test_clean_bars(bars):
    df = bars(range(1, 6), volume=[1.0, -1.0, 1.0, 1.0, 1.0], low=[0.5, 0.5, 3.5, 0.5, 0.5])
    assert sorted(r.close for r in rows.clean_bars(df.unionByName(df)).collect()) == [1.0, 4.0, 5.0]

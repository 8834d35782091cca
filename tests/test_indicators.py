import numpy as np
import pandas as pd
import pytest
from conftest import column
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from barworks.operators import indicators as ind


def prices(n, seed=1, nulls=0.0):
    rng = np.random.default_rng(seed)
    x = 100 + np.cumsum(rng.normal(0, 1, n))
    gone = rng.random(n) < nulls
    return [None if g else float(v) for g, v in zip(gone, x)]


def pandas_rsi(close, period):
    delta = close.diff()
    gain = delta.where(delta > 0, 0).rolling(period, min_periods=1).mean()
    loss = (-delta.where(delta < 0, 0)).rolling(period, min_periods=1).mean()
    return (100 - 100 / (1 + gain / loss)).fillna(50)


def close_to(got, want):
    assert np.allclose(np.array(got, dtype=float), np.array(want, dtype=float), atol=1e-9, equal_nan=True)


def test_indicators_match_pandas_across_blocks(bars, layout):
    x = prices(140)
    s = pd.Series(x)
    df = ind.indicators(bars(x), {"RSI": {"period": 5}, "MACD": {"fast_period": 2, "slow_period": 4, "signal_period": 3},
                                  "SMA": {"window": 6}, "EMA": {"period": 3}}, fill=False)
    close_to(column(df, "RSI_5"), pandas_rsi(s, 5))
    macd = s.ewm(span=2, adjust=False).mean() - s.ewm(span=4, adjust=False).mean()
    close_to(column(df, "MACD_2_4_3"), macd)
    close_to(column(df, "MACD_Signal_2_4_3"), macd.ewm(span=3, adjust=False).mean())
    close_to(column(df, "SMA_6"), s.rolling(6).mean())
    close_to(column(df, "EMA_3"), s.ewm(span=3, adjust=False).mean())


@pytest.mark.parametrize("span", [1, 2, 30, 400])
def test_ema_spans(bars, span):
    x = prices(900, 3)
    close_to(column(ind.ema(bars(x), span), f"EMA_{span}"), pd.Series(x).ewm(span=span, adjust=False).mean())


def test_short_and_long_spans_in_one_set(bars):
    x = prices(800, 4)
    df = ind.indicators(bars(x), {"MACD": {"fast_period": 2, "slow_period": 200, "signal_period": 2}}, fill=False)
    s = pd.Series(x)
    close_to(column(df, "MACD_2_200_2"), s.ewm(span=2, adjust=False).mean() - s.ewm(span=200, adjust=False).mean())


@pytest.mark.parametrize("nulls", [0.3, 0.9])
def test_ema_with_gaps(bars, layout, nulls):
    x = [None, None] + prices(120, 5, nulls) + [None] * 30 + prices(20, 6)
    want = pd.Series(x, dtype=float).ewm(span=4, adjust=False).mean()
    close_to(column(ind.ema(bars(x), 4, gaps=True), "EMA_4"), want)


def test_infinite_close_counts_as_missing_change(bars, layout):
    x = prices(60, 8)
    x[20], x[33], x[34] = float("inf"), float("-inf"), float("inf")
    got = column(ind.rsi(bars(x), 5), "RSI_5")
    close_to(got, pandas_rsi(pd.Series(x), 5))
    sma = pd.Series(x).replace([np.inf, -np.inf], np.nan).rolling(4).mean()
    close_to(column(ind.sma(bars(x), 4), "SMA_4"), sma)


def test_a_missing_close_leaves_no_mean_without_filling(bars, layout):
    x = prices(40, 9)
    x[17] = None
    df = ind.indicators(bars(x), {"MACD": {}, "EMA": {"window": 5}, "RSI": {"period": 5}}, fill=False, flags=True)
    for c in ("MACD_12_26_9", "MACD_Signal_12_26_9", "EMA_5", "RSI_5"):
        assert set(column(df, c)) == {None} and set(column(df, f"_ok_{c}")) == {False}
    close_to(column(ind.ema(bars(x), 5), "EMA_5"), pd.Series(x, dtype=float).ewm(span=5, adjust=False).mean())
    assert set(column(ind.ema(bars(x), 5, gaps=False), "EMA_5")) == {None}


def test_a_huge_price_leaves_no_edge(bars):
    x = prices(1500, 10)
    x[414] = 1e15
    got, want = column(ind.ema(bars(x), 20, gaps=False), "EMA_20"), pd.Series(x).ewm(span=20, adjust=False).mean()
    assert np.allclose(got, want, rtol=1e-12)


def test_a_tick_beyond_all_prices_leaves_no_edge(bars, layout, monkeypatch):
    """Rows far behind a tick of 1e60 still hold what is left of it, over tiles and blocks."""
    monkeypatch.setattr(ind, "_SHARE", 1)
    x = prices(7000, 12)
    x[100], x[3000] = 1e60, -1e60
    for span in (2, 3):
        s = pd.Series(x)
        assert np.allclose(column(ind.ema(bars(x), span, gaps=False), f"EMA_{span}"), s.ewm(span=span, adjust=False).mean(), rtol=1e-11)
        s[[50, 2000, 2001]] = np.nan
        got = column(ind.ema(bars([None if v != v else v for v in s]), span), f"EMA_{span}")
        assert np.allclose(got, s.ewm(span=span, adjust=False).mean(), rtol=1e-11)


def test_a_gap_longer_than_all_memory(bars):
    x = [5.0, 7.0] + [None] * 3000 + [11.0, 13.0]
    got = column(ind.ema(bars(x), 3), "EMA_3")
    assert np.allclose(got, pd.Series(x, dtype=float).ewm(span=3, adjust=False).mean(), rtol=1e-12)
    far = [1e200] + [None] * 700 + [1.0, 2.0]
    got = column(ind.ema(bars(far), 3), "EMA_3")
    assert np.allclose(got, pd.Series(far, dtype=float).ewm(span=3, adjust=False).mean(), rtol=1e-11)


def test_rsi_edges(bars):
    assert set(column(ind.rsi(bars([5.0] * 20)), "RSI_14")) == {50.0}
    assert column(ind.rsi(bars(range(20))), "RSI_14") == [50.0] + [100.0] * 19
    assert set(column(ind.rsi(bars(range(14))), "RSI_14")) == {None}
    assert None not in column(ind.rsi(bars(range(15))), "RSI_14")


def test_rsi_fills_gaps_of_a_copy(bars, layout):
    x = prices(60, 7)
    x[10:13] = [None] * 3
    x[30:39] = [None] * 9
    x[57:] = [None] * 3
    filled = pd.Series(x, dtype=float).interpolate(limit=5).ffill()
    df = ind.rsi(bars(x), 5)
    close_to(column(df, "RSI_5"), pandas_rsi(filled, 5))
    assert column(df, "close") == x


def test_leading_null_fails_macd_but_not_rsi(bars):
    df = ind.indicators(bars([None] + prices(40)), fill=True)
    assert set(column(df, "MACD_12_26_9")) == {None}
    assert column(df, "RSI_14")[0] == 50.0


def test_check_agrees_with_closed_form(bars):
    series = [bars(prices(40), "ok/x"), bars([None] + prices(40), "lead/x"), bars(prices(10), "short/x"),
              bars(prices(20) + [None] + prices(20), "hole/x")]
    df = series[0].unionByName(series[1]).unionByName(series[2]).unionByName(series[3])
    config = {**ind.DEFAULT_INDICATORS, "SMA": {"window": 20}, "EMA": {"window": 20}}
    flags = ind.indicators(df, config, flags=True)
    checks = {(r.pair, r.indicator): r.valid for r in ind.indicator_check(df, config).collect()}
    for r in flags.select("pair", *[f"_ok_{c}" for c in ("RSI_14", "MACD_12_26_9", "SMA_20", "EMA_20")]).distinct().collect():
        for c in ("RSI_14", "MACD_12_26_9", "SMA_20", "EMA_20"):
            assert checks[(r.pair, c)] == r[f"_ok_{c}"], (r.pair, c)


def test_price_change_across_buckets(bars, layout):
    x = prices(50)
    got = column(ind.price_change(bars(x)), "price_change")
    close_to(got, pd.Series(x).diff())


def test_unknown_indicator_is_skipped(bars):
    assert "MA" not in "".join(ind.indicators(bars(range(20)), {"MA": {"SMA": {"period": 5}}}, fill=False).columns)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(-1e6, 1e6), min_size=1, max_size=60), st.integers(2, 12))
def test_scan_equals_loop(bars, x, span):
    a, y, want = 2 / (span + 1), None, []
    for v in x:
        y = v if y is None else a * v + (1 - a) * y
        want.append(y)
    assert np.allclose(column(ind.ema(bars(x), span), f"EMA_{span}"), want, atol=1e-6, rtol=1e-9)

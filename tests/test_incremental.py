from datetime import datetime, timedelta

import numpy as np
import pytest

from barworks.operators import incremental
from barworks.operators.indicators import indicators

T0 = datetime(2024, 1, 1)
CONFIG = {"RSI": {"period": 5}, "MACD": {"fast_period": 3, "slow_period": 6, "signal_period": 4}, "SMA": {"window": 7}, "EMA": {"window": 9}}
COLUMNS = ["RSI_5", "MACD_3_6_4", "MACD_Signal_3_6_4", "SMA_7", "EMA_9"]


def prices(n, seed):
    return [float(v) for v in 100 + np.cumsum(np.random.default_rng(seed).normal(0, 1, n))]


def table(df):
    return {(r.pair, r.timestamp): [r[c] for c in COLUMNS] for r in df.collect()}


def same(got, want):
    assert got.keys() == want.keys()
    for key in want:
        for g, w in zip(got[key], want[key]):
            assert (g is None) == (w is None) and (w is None or abs(g - w) < 1e-9), (key, got[key], want[key])


@pytest.mark.parametrize("cuts", [(30,), (2, 3, 4, 10, 41)])
def test_pieces_give_what_one_pass_gives(bars, layout, cuts):
    series = {"A/x": prices(60, 1), "B/x": prices(8, 2), "C/x": prices(50, 3)}
    whole = None
    for pair, x in series.items():
        df = bars(x, pair)
        whole = df if whole is None else whole.unionByName(df)
    want = table(indicators(whole, CONFIG, fill=False))
    out, state = [], None
    edges = [0, *cuts, 60]
    for a, b in zip(edges, edges[1:]):
        piece = whole.where((whole.timestamp >= T0 + timedelta(hours=a)) & (whole.timestamp < T0 + timedelta(hours=b)))
        rows, state = incremental.advance(piece, state, CONFIG)
        out.append(rows)
    every = out[0]
    for rows in out[1:]:
        every = every.unionByName(rows)
    same(table(incremental.valid_only(every, state, CONFIG)), want)
    assert {r.pair: r.n for r in state.collect()} == {p: len(x) for p, x in series.items()}
    assert max(len(r.closes) for r in state.collect()) == 7


def test_new_series_late_bars_and_missing_closes(bars):
    first = bars(prices(20, 4), "A/x").unionByName(bars(prices(20, 5), "B/x"))
    _, state = incremental.advance(first, None, CONFIG)
    more = bars(prices(25, 6), "C/x").unionByName(bars([7.0] * 12, "A/x", start=T0 + timedelta(hours=10))).unionByName(
        bars([8.0, None, 9.0], "B/x", start=T0 + timedelta(hours=20)))
    assert incremental.late_bars(more, state).count() == 10
    rows, after = incremental.advance(more, state, CONFIG)
    assert sorted((r.pair, r.n, r.n_null) for r in after.collect()) == [("A/x", 22, 0), ("B/x", 23, 1), ("C/x", 25, 0)]
    shown = table(incremental.valid_only(rows, after, CONFIG))
    assert len(shown) == 2 + 3 + 25
    assert all(shown["B/x", T0 + timedelta(hours=h)][0] is None for h in (20, 21, 22))
    want = table(indicators(bars([*prices(20, 4), 7.0, 7.0], "A/x"), CONFIG, fill=False))
    same({k: v for k, v in shown.items() if k[0] == "A/x"}, {k: v for k, v in want.items() if k[1] >= T0 + timedelta(hours=20)})
    nothing, unchanged = incremental.advance(more.where("false"), after, CONFIG)
    assert nothing.count() == 0 and unchanged.count() == 3

import numpy as np
import pandas as pd
from conftest import column

from barworks.operators import fills

X = [None, 1.0, None, None, 4.0] + [None] * 5 + [10.0] + [None] * 6 + [20.0, 3.0] + [None] * 7


def same(got, want):
    assert np.allclose(np.array(got, dtype=float), np.array(want, dtype=float), equal_nan=True)


def test_interpolation_matches_pandas(bars, layout):
    same(column(fills.interpolate_linear(bars(X), ["close"]), "close"), pd.Series(X, dtype=float).interpolate(limit=5))


def test_carry_matches_pandas(bars, layout):
    s = pd.Series(X, dtype=float)
    same(column(fills.ffill(bars(X), ["close"]), "close"), s.ffill())
    same(column(fills.ffill(bars(X), ["close"], 3), "close"), s.ffill(limit=3))
    same(column(fills.bfill(bars(X), ["close"], 3), "close"), s.bfill(limit=3))


def test_longest_run(bars, layout):
    df = bars(X).unionByName(bars([None] * 9, "none/x")).unionByName(bars([1.0] * 9, "full/x"))
    runs = {r.pair: r.run_close for r in fills.null_run_length(df, ["close"]).collect()}
    assert runs == {"A/B": 7, "none/x": 9, "full/x": 0}


def test_fill_gaps_takes_a_branch_per_series(bars, layout):
    short, long = [1.0] + [None] * 5 + [7.0], [1.0] + [None] * 6 + [8.0]
    got = fills.fill_gaps(bars(short, "s/x").unionByName(bars(long, "l/x")))
    rows = {p: [r.close for r in got.where(f"pair = '{p}'").orderBy("timestamp").collect()] for p in ("s/x", "l/x")}
    assert rows["s/x"] == [1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0]
    assert rows["l/x"] == [1.0] * 6 + [8.0] * 2


def test_fill_all_drops_what_stays_null(bars):
    df = bars([None, 2.0, None, None]).unionByName(bars([None, None], "none/x"))
    assert column(fills.fill_all(df), "close") == [2.0] * 4


def test_drop_no_indicator(bars):
    df = bars([1.0, 2.0])
    assert fills.drop_no_indicator(df).count() == 2
    marked = df.selectExpr("*", "if(close = 1, null, close) AS SMA_2", "cast(null AS double) AS RSI_14")
    assert column(fills.drop_no_indicator(marked), "close") == [2.0]

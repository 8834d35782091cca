import statistics

import numpy as np
import pytest
from conftest import column

from barworks.operators import features as ft
from barworks.plans import training


def test_splits_are_disjoint_and_exhaustive(bars, layout):
    got = ft.split_80_10_10(bars(range(57))).orderBy("timestamp").collect()
    assert [r.split for r in got] == ["train"] * 45 + ["val"] * 5 + ["test"] * 7
    assert [r.split_pos for r in got] == [*range(45), *range(5), *range(7)]


def test_sequences_stay_in_their_split(bars, layout):
    got = ft.sequences(bars(range(100)), 4, ["close"]).collect()
    spans = {"train": (0, 80), "val": (80, 90), "test": (90, 100)}
    assert len(got) == 76 + 6 + 6
    for r in got:
        lo, _ = spans[r.split]
        first = lo + r.seq_no
        assert [c[0] for c in r.sequence] == [float(first + i) for i in range(4)]
        assert r.target == float(first + 4)


def test_blocks_of_sequences_hold_each_row_once(bars, layout):
    df = bars(range(300))
    blocks = ft.sequence_blocks(df, 4, ["close", "open"], size=32)
    shape = ["pair", "timeframe", "split", "seq_no", "sequence", "target"]
    assert sorted(map(str, ft.unfold(blocks, 4).select(shape).collect())) == sorted(
        map(str, ft.sequences(df, 4, ["close", "open"]).select(shape).collect()))
    held = blocks.collect()
    assert max(len(r.targets) for r in held) == 32 and all(len(r.rows) == len(r.targets) + 3 for r in held)
    assert sum(len(r.rows) for r in held) < 1.2 * 300
    # a reader's view of a block
    r = held[0]
    views = np.lib.stride_tricks.sliding_window_view(np.array(r.rows), 4, axis=0).swapaxes(1, 2)
    assert views.shape == (len(r.targets), 4, 2) and views[1][0].tolist() == r.rows[1]


def test_extended_sequences_skip_one_row(bars, spark, layout):
    ids = ft.series_ids(spark, ["X/Y", "A/B"], ["1d", "1h"])
    got = ft.sequences_ext(bars(range(30)), *ids, length=5, features=["close"]).orderBy("seq_no").collect()
    assert [r.seq_no for r in got] == list(range(24))
    assert all(r.target == r.sequence[-1][0] + 2 and (r.pair_idx, r.timeframe_idx, r.weight) == (1, 1, 1.0) for r in got)


@pytest.mark.parametrize("n, kept", [(509, 0), (510, 358 + 1 + 1)])
def test_short_series_leave_no_dataset(bars, n, kept):
    assert ft.sequences(bars(range(n)), 50, ["close"], whole_sets=True).count() == kept


def test_minmax(bars, layout):
    x = [4.0, None, 1.0, 2.0, 9.0, None, 3.0]
    df = bars(x, "a/x").unionByName(bars([5.0] * 4, "c/x")).unionByName(bars([None] * 3, "n/x"))
    out = ft.minmax_scale(df, ["close"])
    got = {p: [r.close for r in out.where(f"pair = '{p}'").orderBy("timestamp").collect()] for p in ("a/x", "c/x", "n/x")}
    median = statistics.median([v for v in x if v is not None])
    assert got["a/x"] == [((median if v is None else v) - 1) / 8 for v in x]
    assert got["c/x"] == [0.0] * 4 and got["n/x"] == [None] * 3


@pytest.mark.parametrize("values", [[1.0], [1.0, 2.0], [3.0] * 7 + [1.0], [float(v * v % 101) for v in range(250)]])
def test_median_is_exact(bars, values):
    assert ft.series_median(bars(values), ["close"]).first().median_close == statistics.median(values)


def test_batches_drop_incomplete_and_holed(bars, layout):
    x = [float(i) for i in range(70)]
    x[40] = None
    got = ft.batches(bars(x), 20, ["close"]).orderBy("batch_no").collect()
    assert [r.batch_no for r in got] == [0, 1]
    assert got[1].y == [float(v) for v in range(20, 40)]


def test_training_pairs_need_both_sides(bars):
    assert ft.training_pairs(bars(range(400)), 10, ["close"]).count() == 0
    got = ft.training_pairs(bars(range(600)), 10, ["close"])
    assert {r.split: r["count"] for r in got.groupBy("split").count().collect()} == {"train": 472, "val": 118}


def test_training_checks_fail_in_order(bars):
    seqs = ft.sequences(bars(range(200)), 10, ["close"])
    report = {r.split: r.message for r in ft.training_data_check(seqs).collect()}
    assert report["train"] == "Input features not properly normalized"
    scaled = ft.sequences(ft.minmax_scale(bars(range(200)), ["close"]), 10, ["close"])
    assert {r.message for r in ft.training_data_check(scaled).collect()} == {"Insufficient training samples"}
    odd = scaled.selectExpr("* EXCEPT (target)", "double('NaN') AS target")
    assert {r.message for r in ft.training_data_check(odd).collect()} == {"Training data contains NaN values"}


def test_sequence_checks(bars):
    seqs = ft.sequences(bars(range(600)), 50, ["close"])
    assert all(r.valid for r in ft.sequence_check(seqs).collect())
    assert all(r.valid for r in ft.dims_check(seqs, 50, 1).collect())
    assert not any(r.valid for r in ft.dims_check(seqs, 50, 2).collect())
    assert all(r.valid for r in ft.dataset_check(seqs).collect())
    short = ft.sequences(bars(range(100)), 5, ["close"])
    assert {r.message for r in ft.sequence_check(short).collect()} == {"Sequence length too short"}


def wave(n):
    return [100 + (i * 37 % 23) - (i * 11 % 7) for i in range(n)]


def rows_of(df):
    return {(r.pair, r.split, r.seq_no): ([[round(c, 6) if c is not None else None for c in row] for row in r.sequence], r.target)
            for r in df.collect()}


CONFIG = {"RSI": {"period": 5}, "MACD": {"fast_period": 2, "slow_period": 4, "signal_period": 3}, "SMA": {"window": 6}}


def test_gated_and_general_paths_agree(bars, layout):
    df = bars(wave(130), "a/x").unionByName(bars(wave(150), "b/x"))
    fast, general = (rows_of(training.training_set(df, CONFIG, 5, gate=g)) for g in (True, False))
    assert fast == general and len(fast) > 200


def test_gate_rejects_a_series_with_a_hole(bars):
    df = bars(wave(130), "a/x").unionByName(bars([*wave(60), None, *wave(70)], "b/x"))
    assert {k[0] for k in rows_of(training.training_set(df, CONFIG, 5))} == {"a/x"}
    assert {k[0] for k in rows_of(training.training_set(df, CONFIG, 5, gate=False))} == {"a/x", "b/x"}


def test_invalid_indicator_is_null_and_keeps_the_series(bars):
    got = training.features(bars(wave(10)), {"RSI": {}, "MACD": {}}).collect()
    assert len(got) == 10 and {r.RSI_14 for r in got} == {None}


def test_process_series_drops_a_failing_series(bars):
    df = bars(wave(60), "a/x", volume=[float(i) + 1 for i in range(60)]).unionByName(bars([5.0] * 60, "flat/x"))
    assert set(column(training.process_series(df), "pair")) == {"a/x"}


def test_a_series_without_an_indicator_is_judged_by_the_rest(bars):
    df = bars([*wave(60)], "a/x", volume=[float(i) + 1 for i in range(60)]).unionByName(
        bars(wave(14), "b/x", volume=[float(i) + 1 for i in range(14)]))
    assert set(column(training.process_series(df), "pair")) == {"a/x", "b/x"}


def test_float_output(bars):
    got = training.training_set(bars(wave(130)), CONFIG, 5, as_float=True)
    assert dict(got.dtypes)["sequence"] == "array<array<float>>"


def test_no_indicators_at_all(bars, layout):
    got = training.training_set(bars(wave(130)), {}, 5).collect()
    assert {len(r.sequence[0]) for r in got} == {5} and len(got) == 130 - 15


def test_two_means_drop_the_longer_warmup(bars):
    config = {"SMA": {"window": 4}, "EMA": {"window": 3}}
    assert training.features(bars(wave(20)), config).count() == 17
    assert training.features(bars(wave(3)), config).count() == 3

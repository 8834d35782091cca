import json
from datetime import datetime, timedelta

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from conftest import column
from pyspark.sql import functions as F

from barworks.sources import store
from barworks.streaming.pages import pages_to_store

T0 = datetime(2024, 1, 1)


def written(path):
    return {p: p.stat().st_size for p in path.rglob("*.parquet")}


def test_a_daily_write_costs_what_it_brings(bars, spark, tmp_path):
    root = str(tmp_path / "raw")
    history = [bars(range(3000), f"{p}/x", "1d", datetime(2015, 1, 1)) for p in "ABCD"]
    store.write_bars(history[0].unionByName(history[1]).unionByName(history[2]).unionByName(history[3]), root, ["timeframe"])
    before = written(tmp_path / "raw/writes")
    day = [bars([5.0], f"{p}/x", "1d", datetime(2015, 1, 1) + timedelta(days=3000)) for p in "ABCD"]
    store.write_bars(day[0].unionByName(day[1]).unionByName(day[2]).unionByName(day[3]), root, ["timeframe"])
    after = written(tmp_path / "raw/writes")
    assert {p: n for p, n in after.items() if p in before} == before
    assert sum(after.values()) - sum(before.values()) < 0.1 * sum(before.values())
    assert store.read_bars(spark, root).count() == 4 * 3001


def test_reading_settles_only_files_that_meet_in_time(bars, spark, tmp_path):
    root = str(tmp_path / "raw")
    store.write_bars(bars([1, 2, 3]), root)
    store.write_bars(bars([4], start=T0 + timedelta(hours=3)), root)

    def plan():
        return store.read_bars(spark, root)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan()
    store.write_bars(bars([9, 5], start=T0 + timedelta(hours=3)), root)
    assert "Window" in plan()
    assert column(store.read_bars(spark, root), "close") == [1.0, 2.0, 3.0, 4.0, 5.0]


def test_times_and_keys_choose_the_files(bars, spark, tmp_path):
    root = str(tmp_path / "raw")
    for day in range(4):
        df = bars([day, day], "A/x", start=T0 + timedelta(days=day)).unionByName(bars([10 + day], "B/x", start=T0 + timedelta(days=day)))
        store.write_bars(df, root)

    def files(**asked):
        return len(store.read_bars(spark, root, **asked).inputFiles())
    assert files() == 8 and files(pair="B/x") == 4
    asked = dict(pair="A/x", start=T0 + timedelta(days=1, hours=1), end=T0 + timedelta(days=2, hours=1))
    assert files(**asked) == 2
    assert column(store.read_bars(spark, root, **asked), "close") == [1.0, 2.0]
    assert store.read_bars(spark, root, pair="C/x").count() == 0 and store.read_bars(spark, root, start=T0 + timedelta(days=9)).count() == 0


def test_two_writers_that_start_from_one_version(bars, spark, tmp_path, monkeypatch):
    root = str(tmp_path / "raw")
    store.write_bars(bars([1], "A/x").unionByName(bars([1], "B/x")), root)
    publish, calls = store._publish, []

    def late(spark_, root_, commit):
        calls.append(commit.number)
        if len(calls) == 1:  # another writer commits first
            monkeypatch.setattr(store, "_publish", publish)
            store.write_bars(bars([1, 5], "A/x").unionByName(bars([1, 7], "C/x")), root)
            monkeypatch.setattr(store, "_publish", late)
        return publish(spark_, root_, commit)
    monkeypatch.setattr(store, "_publish", late)
    writes = len(list((tmp_path / "raw/writes").glob("write=*")))
    assert store.write_bars(bars([1, 6], "A/x").unionByName(bars([1, 8], "B/x")), root) == 3
    assert calls == [2, 3]
    assert len(list((tmp_path / "raw/writes").glob("write=*"))) == writes + 2  # nothing was written twice
    got = {(r.pair, r.timestamp.hour): r.close for r in store.read_bars(spark, root).collect()}
    # the writer that committed first wins where both have a bar
    assert got == {("A/x", 0): 1.0, ("A/x", 1): 5.0, ("B/x", 0): 1.0, ("B/x", 1): 8.0, ("C/x", 0): 1.0, ("C/x", 1): 7.0}
    assert store.versions(spark, root) == [1, 2, 3]


def test_two_merges_of_the_same_files(bars, spark, tmp_path, monkeypatch):
    root = str(tmp_path / "raw")
    for day in range(3):
        store.write_bars(bars([day], start=T0 + timedelta(days=day)), root)
    publish = store._publish

    def late(spark_, root_, commit):
        monkeypatch.setattr(store, "_publish", publish)
        assert store.merge_layers(spark, root, most=1) == 4
        return publish(spark_, root_, commit)
    monkeypatch.setattr(store, "_publish", late)
    assert store.merge_layers(spark, root, most=1) is None
    store.write_bars(bars([7, 8], start=T0 + timedelta(days=2)), root)
    assert column(store.read_bars(spark, root), "close") == [0.0, 1.0, 2.0, 8.0]


def test_a_layer_that_comes_while_others_are_merged(bars, spark, tmp_path, monkeypatch):
    root = str(tmp_path / "raw")
    for day in range(3):
        store.write_bars(bars([day], start=T0 + timedelta(days=day)), root)
    publish = store._publish

    def late(spark_, root_, commit):
        monkeypatch.setattr(store, "_publish", publish)
        store.write_bars(bars([9, 4], start=T0 + timedelta(days=2)), root)
        return publish(spark_, root_, commit)
    monkeypatch.setattr(store, "_publish", late)
    assert store.merge_layers(spark, root, most=1) == 5
    assert column(store.read_bars(spark, root), "close") == [0.0, 1.0, 2.0, 4.0]


def test_many_layers_merge_and_old_versions_go(bars, spark, tmp_path, monkeypatch):
    root = str(tmp_path / "raw")
    monkeypatch.setattr(store, "FULL_EVERY", 4)
    monkeypatch.setattr(store, "MOST_LAYERS", 3)
    merge = store.merge_layers
    monkeypatch.setattr(store, "merge_layers", lambda *given: merge(*given, most=3))
    for day in range(9):
        store.write_bars(bars([day, 99], start=T0 + timedelta(hours=day)), root)
    # a bar that came as the second of one write stays when the next brings it again
    assert column(store.read_bars(spark, root), "close") == [0.0] + [99.0] * 9
    layers = store.manifest(spark, root, store.versions(spark, root)[-1])
    assert layers.select("layer").distinct().count() <= 4
    kept = store.versions(spark, root)
    assert len(kept) == 4
    for version in kept:
        assert store.read_bars(spark, root, version=version).count() > 6
    held = {r.path for v in kept for r in store.manifest(spark, root, v).collect()}
    assert {str(p.relative_to(tmp_path / "raw/writes")) for p in written(tmp_path / "raw/writes")} == held
    assert min(store._numbers(spark, root)) > 4


def test_a_flipped_cell_is_refused(bars, spark, tmp_path):
    root = str(tmp_path / "raw")
    store.write_bars(bars([1, 2, 3]), root)
    store.write_bars(bars([4], start=T0 + timedelta(hours=3)), root)
    assert store.damaged_files(spark, root).count() == 0
    (path,) = (tmp_path / "raw/writes/write=1").rglob("*.parquet")
    table = pq.read_table(path, partitioning=None)
    cells = table["close"].to_pylist()
    cells[1] += 1
    flipped = table.set_column(table.column_names.index("close"), "close", pa.array(cells))
    pq.write_table(flipped, path, use_deprecated_int96_timestamps=True)
    (path.parent / f".{path.name}.crc").unlink()
    assert [(r.rows, r.found) for r in store.damaged_files(spark, root).collect()] == [(3, 3)]
    with pytest.raises(IOError, match="does not hold"):
        store.merge_layers(spark, root, share=0, least_rows=0)


def test_what_is_written_is_read_back_and_compared(bars, spark, tmp_path, monkeypatch):
    described = store._described

    def damaged(spark_, root_, df):
        return described(spark_, root_, df).withColumn("digest_xor", F.col("digest_xor") + 1)
    monkeypatch.setattr(store, "_described", damaged)
    with pytest.raises(IOError, match="does not hold"):
        store.write_bars(bars([1, 2]), str(tmp_path / "raw"))
    assert store.read_bars(spark, str(tmp_path / "raw")) is None


def page(*hours):
    return json.dumps([[int((T0 + timedelta(hours=h)).timestamp() * 1000), 1.0, 2.0, 0.5, h + 1.0, 3.0] for h in hours])


def test_a_stream_lands_each_batch_once(spark, tmp_path):
    landing, root, progress = (str(tmp_path / n) for n in ("landing", "raw", "progress"))
    refused = str(tmp_path / "refused")

    def drop(*pages):
        spark.createDataFrame(pages, "pair string, timeframe string, page_no long, candles string").coalesce(1).write.mode("append").parquet(landing)

    def run():
        pages_to_store(spark, landing, root, progress, refused).awaitTermination()
    drop(("A/x", "1h", 0, page(0, 1)), ("A/x", "1h", 1, page(3, 2)))
    run()
    drop(("A/x", "1h", 2, page(1, 2)), ("B/x", "1h", 0, page(5)))
    run()
    run()
    assert store.versions(spark, root) == [1, 2]
    assert column(store.read_bars(spark, root), "close") == [1.0, 2.0, 3.0, 6.0]
    assert [r.reason for r in spark.read.parquet(refused).collect()] == ["out of order"]
    # the last batch is taken back as if it had not been acknowledged: it runs again and changes nothing
    (tmp_path / "progress/commits/1").unlink()
    (tmp_path / "progress/commits/.1.crc").unlink()
    run()
    assert store.versions(spark, root) == [1, 2]
    assert column(store.read_bars(spark, root), "close") == [1.0, 2.0, 3.0, 6.0]
    drop(("A/x", "1h", 3, page(9)))
    run()
    assert store.versions(spark, root) == [1, 2, 3]


def test_missing_ranges(bars, spark, monkeypatch):
    monkeypatch.setattr(store, "SLOTS", 4)
    held = {0, 1, 5, 6, 20, 21, 40}
    stored = bars([1.0] * len(held), at=[T0 + timedelta(hours=h) for h in sorted(held)]).unionByName(
        bars([1.0, 1.0], "B/x", "1m", at=[T0 + timedelta(minutes=3, seconds=20), T0 + timedelta(minutes=3)]))
    windows = [("A/B", "1h", -3, 50), ("A/B", "1h", 2, 3), ("A/B", "1h", 0, 2), ("A/B", "1h", 7, 19), ("A/B", "1h", 30, 90), ("none", "1h", 4, 9),
               ("A/B", "7h", 0, 9), ("A/B", "1h", 5, 5), ("A/B", "1h", None, 5), ("A/B", "1h", 2, 3)]
    asked = spark.createDataFrame([(p, t, None if a is None else T0 + timedelta(hours=a), T0 + timedelta(hours=b)) for p, t, a, b in windows],
                                  "pair string, timeframe string, start timestamp, end timestamp")
    want = []
    for pair, timeframe, a, b in sorted({w for w in windows if w[1] == "1h" and w[2] is not None}):
        gone = [h for h in range(a, b) if pair == "none" or h not in held]
        runs = [h for h in gone if h - 1 not in gone]
        for h in runs:
            to = next(x for x in range(h, b + 1) if x not in gone)
            want.append((pair, T0 + timedelta(hours=h), T0 + timedelta(hours=to), to - h))
    got = store.missing_ranges(asked, stored)
    assert sorted((r.pair, r.start, r.end, r.n_bars) for r in got.collect()) == sorted(want)
    minutes = spark.createDataFrame([("B/x", "1m", T0, T0 + timedelta(minutes=5, seconds=30))], asked.schema)
    assert [(r.start.minute, r.end.minute, r.n_bars) for r in store.missing_ranges(minutes, stored).orderBy("start").collect()] == [(0, 3, 3), (4, 6, 2)]


def test_statistics_come_without_the_bars(bars, spark, tmp_path, monkeypatch):
    root = str(tmp_path / "raw")
    x = [[1.0, 5.0, None, 9.0], [4.0, 1e6, 3.0], [float("nan"), 2.0]]
    for day, close in enumerate(x):
        store.write_bars(bars(close, start=T0 + timedelta(days=day)).unionByName(bars([7.0], "B/x", start=T0 + timedelta(days=day))), root)

    def figures():
        rows = {r.pair: r for r in store.series_statistics(spark, root).collect()}
        return rows["A/B"], rows["B/x"]
    monkeypatch.setattr(store, "_bars", None)  # no bar is read
    a, b = figures()
    seen = np.array([v for part in x for v in part if v is not None and v == v])
    close = a["columns"]["close"]
    assert (a.rows, close.n, close.low, close.high) == (9, 7, 1.0, 1e6)
    assert np.allclose((close["mean"], close.m2), (seen.mean(), ((seen - seen.mean()) ** 2).sum()), rtol=1e-12)
    assert b["columns"]["close"].m2 == 0 and b.n_bad_volume == 0
    monkeypatch.undo()
    store.write_bars(bars([8.0, 8.0, 8.0, 8.0, 6.0]), root)  # meets the first day: four bars are stored already
    a, _ = figures()
    assert (a.rows, a["columns"]["close"].n) == (10, 8)
    store.merge_layers(spark, root, most=1)
    assert (figures()[0].rows, figures()[0]["columns"]["close"].n) == (10, 8)
    judged = {r.pair: (r.error, r.valid) for r in store.stored_quality(spark, root, ["close"]).collect()}
    assert judged == {"A/B": ("Too many missing values", False), "B/x": ("Low variance detected", False)}

import json
from datetime import datetime, timedelta

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from conftest import column
from pyspark.sql import functions as F

from barworks.functions.schema import downcast
from barworks.operators import sentiment, ttl
from barworks.sources import candles, store, texts

T0 = datetime(2024, 1, 1)


def test_store_round_trip(bars, spark, tmp_path):
    root = str(tmp_path / "raw")
    assert store.read_bars(spark, root) is None
    assert store.write_bars(bars([]), root) is None
    first = bars([1, 2, 3]).unionByName(bars([7], "007"))
    assert store.write_bars(first, root) == 1
    assert store.write_bars(bars([9, 9, 9, 4]), root) == 2
    assert column(store.read_bars(spark, root, pair="A/B"), "close") == [1.0, 2.0, 3.0, 4.0]
    assert column(store.read_bars(spark, root, pair="007"), "close") == [7.0]
    assert store.read_bars(spark, root, pair="A/B", timeframe="4h").count() == 0
    for _ in range(4):
        store.write_bars(bars([1]), root)
    assert store.versions(spark, root) == [3, 4, 5, 6]
    stats = store.storage_stats(spark, root).first()
    assert (stats.file_count, stats.backup_count, stats.backup_bytes) == (7, 0, 0) and stats.total_bytes > 0  # layers are shared
    assert store.merge_layers(spark, root, most=1) == 7
    merged = store.storage_stats(spark, root).first()
    assert (merged.file_count, merged.backup_count) == (3, 5) and merged.backup_bytes + merged.total_bytes > stats.total_bytes
    assert column(store.read_bars(spark, root), "close") == [7.0, 1.0, 2.0, 3.0, 4.0]
    assert column(store.read_bars(spark, root, version=3), "close") == [7.0, 1.0, 2.0, 3.0, 4.0]


def test_a_write_leaves_other_partitions_alone(bars, spark, tmp_path):
    root = str(tmp_path / "raw")
    store.write_bars(bars([1, 2], "A/x").unionByName(bars([3, 4], "B/x")).unionByName(bars([5], "C/x")), root)
    store.write_bars(bars([9, 9, 7], "B/x"), root)
    assert [p.name for p in (tmp_path / "raw/writes/write=2").glob("pair=*")] == ["pair=B%2Fx"]
    assert column(store.read_bars(spark, root), "close") == [1.0, 2.0, 3.0, 4.0, 7.0, 5.0]
    assert column(store.read_bars(spark, root, version=1), "close") == [1.0, 2.0, 3.0, 4.0, 5.0]


def test_first_write_keeps_one_bar_per_time(bars, spark, tmp_path):
    root = str(tmp_path / "raw")
    store.write_bars(bars([1, 2]).unionByName(bars([1, 2])), root)
    assert store.read_bars(spark, root).count() == 2


def test_columns_of_both_writes_stay(bars, spark, tmp_path):
    root = str(tmp_path / "raw")
    store.write_bars(bars([1, 2]).withColumn("RSI_14", F.lit(40.0)), root)
    store.write_bars(bars([8, 8, 3]), root)
    got = store.read_bars(spark, root).orderBy("timestamp").collect()
    assert [(r.close, r.RSI_14) for r in got] == [(1.0, 40.0), (2.0, 40.0), (3.0, None)]
    with pytest.raises(ValueError, match="RSI_14"):
        store.write_bars(bars([1]).withColumn("RSI_14", F.lit("x")), root)
    with pytest.raises(ValueError, match="partitioned"):
        store.write_bars(bars([1]), root, partition_by=["timeframe"])


def test_refused_inputs_are_named(spark, bars):
    pages = spark.createDataFrame([(0, page(1, 2)), (1, page(2, 1)), (2, "[[1"), (3, None)], "page_no int, candles string")
    assert {r.page_no: r.reason for r in candles.refused_pages(pages).collect()} == {1: "out of order", 2: "not readable", 3: "missing"}
    posts = spark.createDataFrame([(0, '{"data": {"children": []}}'), (1, "{}"), (2, '{"data": {"chil'), (3, None)], "n int, payload string")
    assert {r.n: r.reason for r in texts.refused_payloads(posts).collect()} == {1: "no posts", 2: "not readable", 3: "missing"}
    df = bars([1, 2], "a/x").unionByName(bars([1, None], "b/x")).unionByName(bars([1, 2], "c/x", high=[-9.0, 9.0]))
    assert {r.pair: (r.n_rows, r.n_incomplete, r.n_crossed) for r in candles.refused_series(df).collect()} == {"b/x": (2, 1, 0), "c/x": (2, 0, 1)}
    assert set(column(candles.reject_series(df), "pair")) == {"a/x"}


def test_files_stay_sorted_when_partitioned_by_timeframe(bars, spark, tmp_path):
    root = str(tmp_path / "raw")
    df = bars(range(5), "B/x").unionByName(bars(range(5), "A/x")).unionByName(bars(range(5), "C/x"))
    store.write_bars(df.orderBy(F.rand(1)), root, partition_by=["timeframe"])
    for path in (tmp_path / "raw" / "writes").rglob("*.parquet"):
        rows = pq.read_table(path, columns=["pair", "timestamp"], partitioning=None).to_pylist()
        assert rows == sorted(rows, key=lambda r: (r["pair"], r["timestamp"]))
    assert store.read_bars(spark, root).count() == 15


def test_nan_is_read_as_null(bars, spark, tmp_path):
    root = str(tmp_path / "raw")
    assert store.storage_stats(spark, root).first().file_count == 0
    store.write_bars(bars([1, float("nan"), float("inf")]), root)
    assert column(store.read_bars(spark, root), "close") == [1.0, None, float("inf")]


def test_key_filters_prune_partitions(bars, spark, tmp_path):
    store.write_bars(bars([1, 2]), str(tmp_path / "raw"))
    plan = store.read_bars(spark, str(tmp_path / "raw"), pair="A/B")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(pair" in plan


def test_merge_is_idempotent(bars):
    old, new = bars([1, 2, 3]), bars([8, 8, 8, 4])
    once = store.merge_bars(old, new)
    assert column(once, "close") == column(store.merge_bars(once, new), "close") == [1.0, 2.0, 3.0, 4.0]


def test_unfinished_version_is_ignored(bars, spark, tmp_path):
    root = tmp_path / "raw"
    store.write_bars(bars([1]), str(root))
    (root / "version=2").mkdir()
    assert store.versions(spark, str(root)) == [1]


def test_legacy_files(spark, tmp_path):
    frame = pa.table({"timestamp": pa.array([T0, T0 + timedelta(hours=1)], pa.timestamp("ns")),
                      **{c: [1.0, 2.0] for c in ("open", "high", "low", "close", "volume")}})
    pq.write_table(frame, tmp_path / "BTC_USDT_1h.parquet")
    got = store.read_legacy_files(spark, str(tmp_path)).orderBy("timestamp").collect()
    assert [(r.pair, r.timeframe, r.timestamp) for r in got] == [("BTC/USDT", "1h", T0), ("BTC/USDT", "1h", T0 + timedelta(hours=1))]


def test_downcast_respects_ranges(spark):
    df = spark.createDataFrame([(1, 2**31 - 1, 0.5)], "a bigint, b bigint, c double")
    assert [t for _, t in downcast(df).dtypes] == ["int", "bigint", "float"]


def page(*ms):
    return json.dumps([[m, 1.0, 2.0, 0.5, 1.5, 3.0] for m in ms])


def test_pages(spark):
    pages = spark.createDataFrame([("A/B", "1h", 0, page(1000, 1000, 2000)), ("A/B", "1h", 1, page(5000, 4000)),
                                   ("A/B", "1h", 2, "[]")], "pair string, timeframe string, page_no int, candles string")
    assert {r.page_no for r in candles.ordered_pages(pages).collect()} == {0, 2}
    got = candles.combine_pages(pages).orderBy("pos").collect()
    assert [r.timestamp for r in got] == [datetime(1970, 1, 1, 0, 0, s) for s in (1, 1, 2)]


def test_rejected_choice_does_not_fall_through(bars, spark):
    bad, good = bars([1, 2], high=[0.0, 0.0]), bars([3, 4])
    offers = bad.selectExpr("*", "'binance' AS exchange").unionByName(good.selectExpr("*", "'okx' AS exchange"))
    exchanges = spark.createDataFrame([("binance", 1, True), ("okx", 4, True)], "exchange string, priority int, enabled boolean")
    picked = candles.pick_source(offers, exchanges).drop("exchange")
    assert column(picked, "close") == [1.0, 2.0]
    assert candles.reject_series(picked).count() == 0


def test_chunks_walk_back(spark):
    asked = spark.createDataFrame([("BNB/USDT", "1h", T0, T0 + timedelta(hours=1210)), ("X/Y", "1d", T0, T0)],
                                  "pair string, timeframe string, start timestamp, end timestamp")
    got = candles.plan_chunks(asked).orderBy("chunk_no").collect()
    assert [r.limit for r in got] == [500, 500, 210]
    assert got[-1].chunk_start == T0 and got[0].chunk_end == T0 + timedelta(hours=1210)
    assert all(a.chunk_start == b.chunk_end for a, b in zip(got, got[1:]))


def post(title, body=""):
    return {"data": {"title": title, "selftext": body}}


def payload(spark, children):
    return spark.createDataFrame([("r", json.dumps({"data": {"children": children}}))], "sub string, payload string")


def test_reddit_stops_after_the_post_that_reaches_the_limit(spark):
    long = "x" * 51
    children = [post(long)] + [post(long, long)] * 60
    assert texts.reddit_texts(payload(spark, children), limit=100).count() == 101
    assert texts.reddit_texts(payload(spark, children)).count() == 121
    assert texts.reddit_texts(payload(spark, [post("y" * 50, long), post("", "z" * 49)])).count() == 1
    empty = spark.createDataFrame([("r", "{}"), ("r", None)], "sub string, payload string")
    assert texts.reddit_texts(empty).count() == 0


def test_page_texts():
    long = "word " * 20
    html = f"<article><h2>{long}head</h2><p>{long}one<p>{long}two<script>var x='{long}'</script></article><p>short</p>"
    assert texts.page_texts(html, "other.example") == [f"{long}head", f"{long}one", f"{long}two"]
    nested = texts.page_texts(html, "cointelegraph.com")
    assert len(nested) == 2 and nested[1] == f"{long}head" and nested[0].startswith(f"{long}head{long}one")
    unclosed = f"<article><p><b>{long}<br>{long}</article><footer>{long}</footer></p>"
    assert texts.page_texts(unclosed, "other.example") == [(long + long).strip()]
    assert len(texts.page_texts(f"<p>{long}</p>" * 150, "other.example")) == 150
    assert len(texts.page_texts(f"<p>{long}</p>" * 150, "other.example", 100)) == 100


def test_text_sentiment(spark):
    lexicon = spark.createDataFrame([("good", 0.5, 0.25), ("bad", -1.0, 0.75)], "word string, polarity double, subjectivity double")
    docs = spark.createDataFrame([("en", T0.date(), 1, "Good, good BAD!"), ("en", T0.date(), 2, "nothing"), ("en", T0.date(), 3, "")],
                                 "currency string, date date, doc_id bigint, text string")
    got = {r.doc_id: (r.polarity, r.subjectivity) for r in sentiment.text_sentiment(docs, lexicon).collect()}
    assert got[1] == (0.0, (0.25 + 0.25 + 0.75) / 3) and got[2] == got[3] == (0.0, 0.0)
    accents = spark.createDataFrame([("très", 0.5, 0.25), ("don't", -1.0, 0.75)], "word string, polarity double, subjectivity double")
    texts_ = spark.createDataFrame([("fr", T0.date(), 1, "TRÈS, très; don't"), ("fr", T0.date(), 2, None)], docs.schema)
    got = {r.doc_id: r.polarity for r in sentiment.text_sentiment(texts_, accents).collect()}
    assert got == {1: 0.0, 2: 0.0}


def test_ttl(spark):
    rows = [("a", "old", T0, T0 + timedelta(hours=1)), ("a", "new", T0 + timedelta(minutes=1), T0 + timedelta(hours=2)),
            ("b", "x", T0, T0 + timedelta(hours=1)), ("c", "y", T0 - timedelta(days=2), T0 + timedelta(days=9))]
    cache = spark.createDataFrame(rows, "key string, data string, written_at timestamp, expires_at timestamp")
    assert {r.key: r.data for r in ttl.ttl_latest(cache).collect()} == {"a": "new", "b": "x", "c": "y"}
    now = "2024-01-01 01:00:00"
    assert {r.key for r in ttl.ttl_get(cache, now).collect()} == {"a", "c"}
    assert {r.key for r in ttl.ttl_cleanup(cache, now).collect()} == {"a", "b"}

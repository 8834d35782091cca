"""Time the headline queries; prints one JSON line."""

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from barworks.operators import features as ft  # noqa: E402
from barworks.operators import fills, indicators, quality  # noqa: E402
from barworks.plans import training  # noqa: E402
from barworks.plans.catalog import QUERIES  # noqa: E402
from barworks.plans.fixtures import view  # noqa: E402
from barworks.session import local_session, shared_folder  # noqa: E402
from barworks.sources import candles, store  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
STORE = []  # the folder of the stored bars, once a session is there to name it


def on_suppliers(operator):
    """Run an operator on the stored bars of all suppliers (1,000 daily series at sf0.1)."""
    return lambda spark, sf: operator(store.read_bars(spark, STORE[0]))


HEADLINE = {
    "read_bars_supplier": on_suppliers(lambda b: b),
    "price_change_supplier": on_suppliers(indicators.price_change),
    "rsi_supplier": on_suppliers(lambda b: indicators.rsi(b, fill=False)),
    "macd_supplier": on_suppliers(lambda b: indicators.macd(b, fill=False)),
    "sma_supplier": on_suppliers(indicators.sma),
    "indicators_supplier": on_suppliers(lambda b: indicators.indicators(b, fill=False)),
    "interpolate_supplier": on_suppliers(fills.interpolate_linear),
    "minmax_supplier": on_suppliers(lambda b: ft.minmax_scale(b, ["close", "volume"])),
    "quality_supplier": on_suppliers(quality.quality_report),
    "training_set_supplier": on_suppliers(training.training_set),
    "training_set_ungated_supplier": on_suppliers(lambda b: training.training_set(b, gate=False)),
    "reject_series_supplier": on_suppliers(candles.reject_series),
    **{name: QUERIES[name] for name in (
        "training_set", "process_series", "sequences_50", "fill_gaps", "timestamp_report", "merge_bars", "reddit_texts",
        "news_texts", "sentiment_features", "ttl_get")},
}


def main():
    spark = local_session(CPUS, "bench")
    view(spark, SF_DIR, "bars_day").write.format("noop").mode("overwrite").save()  # start the JVM's engines
    seconds = {}
    start = time.time()
    STORE.append(shared_folder(spark))
    store.write_bars(view(spark, SF_DIR, "bars_supplier"), STORE[0], partition_by=["timeframe"])
    seconds["write_bars_supplier"] = round(time.time() - start, 3)
    # many series, then a second write that touches one of them
    small = shared_folder(spark)
    store.write_bars(view(spark, SF_DIR, "bars_day"), small)
    start = time.time()
    store.write_bars(view(spark, SF_DIR, "bars_day").where("pair = 'A/F'"), small)
    seconds["write_one_series"] = round(time.time() - start, 3)
    for name, query in HEADLINE.items():
        start = time.time()
        query(spark, SF_DIR).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - start, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(json.dumps({"metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1], "cpus": int(CPUS),
                      "spark": spark.version}))


if __name__ == "__main__":
    main()

"""Landed exchange candles: parsing, acceptance, choice of source, request planning."""

from functools import reduce

from pyspark.sql import functions as F

from barworks.functions.schema import (
    DEFAULT_TIMEFRAMES, KEYS, VALUES, bars_per_year, from_epoch_ms, missing_to_null, timeframe_seconds)
from barworks.operators.positions import with_facts

CANDLES = "array<array<double>>"
# Candles per request, by pair; every other pair takes the default.
PAGE_LIMITS = {"BNB/USDT": 500}
PAGE_LIMIT = 1000
# Historic candles per request, by exchange; every other exchange takes the default.
HISTORIC_LIMITS = {"okx": 100}
HISTORIC_LIMIT = 1000
# Exchanges in order of preference.
EXCHANGE_PRIORITY = {"binance": 1, "binanceus": 2, "bybit": 3, "okx": 4}


def read_candles(pages, payload="candles"):
    """`[[ms, o, h, l, c, v], ...]` JSON per page to typed bars; other columns stay."""
    parsed = pages.withColumn("_c", F.from_json(payload, CANDLES)).drop(payload)
    rows = parsed.select(*parsed.drop("_c").columns, F.posexplode("_c").alias("pos", "_r"))
    out = rows.select(*[c for c in rows.columns if c not in ("_r", "pos")], F.col("pos").cast("bigint").alias("pos"),
                      from_epoch_ms(F.col("_r")[0]).alias("timestamp"),
                      *[F.col("_r")[i].alias(c) for i, c in enumerate(VALUES, 1)])
    return missing_to_null(out, VALUES)


def ordered_pages(pages, payload="candles"):
    """Pages whose times never step back. The test runs inside the row, so nothing is shuffled."""
    times = F.transform(F.from_json(payload, CANDLES), lambda c: c[0])
    return pages.where(times == F.array_sort(times))


def refused_pages(pages, payload="candles"):
    """Pages that give no bars, and why: missing, not readable, or times that step back."""
    parsed = F.from_json(payload, CANDLES)
    times = F.transform(parsed, lambda c: c[0])
    reason = (F.when(F.col(payload).isNull(), F.lit("missing")).when(parsed.isNull(), F.lit("not readable"))
              .when(~F.coalesce(times == F.array_sort(times), F.lit(False)), F.lit("out of order")))
    return pages.withColumn("reason", reason).where(F.col("reason").isNotNull()).drop(payload)


def combine_pages(pages, payload="candles"):
    """S3: all bars of all accepted pages, in no promised order and without dedup."""
    return read_candles(ordered_pages(pages, payload), payload)


def reject_series(df, keys=KEYS):
    """Only series without any NULL cell and without a bar whose high is below its low."""
    faults = {"_bad": (F.count_if(bad_bar(df, keys)), "sum")}
    return with_facts(df, faults, keys).where("_bad = 0").drop("_bad")


def refused_series(df, keys=KEYS):
    """The series that `reject_series` drops, with the bars that are incomplete and those that are crossed."""
    cells = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in df.columns if c not in keys])
    out = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(cells).alias("n_incomplete"),
                                F.count_if(F.col("high") < F.col("low")).alias("n_crossed"))
    return out.where("n_incomplete > 0 or n_crossed > 0")


def bad_bar(df, keys=KEYS):
    cells = [F.col(c).isNull() for c in df.columns if c not in keys]
    return reduce(lambda a, b: a | b, cells) | F.coalesce(F.col("high") < F.col("low"), F.lit(True))


def pick_source(candidates, exchanges, keys=KEYS):
    """Bars of the enabled exchange with the best priority among those that answered for the series.

    An answer that S4 rejects later does not make way for the next exchange.
    """
    # exchanges are a short list; bars of any other, or of a disabled one, are no offers
    known = exchanges.where("enabled").select("exchange", "priority")
    offers = candidates.join(known, "exchange")
    best = {"_best": (F.min(F.struct("priority", "exchange")), "min")}
    chosen = with_facts(offers, best, keys).where(F.col("exchange") == F.col("_best.exchange"))
    return chosen.select(*candidates.columns)


def plan_chunks(requests):
    """The windows that walk back from `end` to `start`; the last one is clipped to `start`.

    `requests` holds pair, timeframe, start, end. Every window becomes a row a reader can map over.
    """
    limit = reduce(lambda acc, kv: acc.when(F.col("pair") == kv[0], F.lit(kv[1])), PAGE_LIMITS.items(), F)
    rows = requests.withColumn("_l", limit.otherwise(F.lit(PAGE_LIMIT)).cast("bigint"))
    rows = rows.withColumn("_w", timeframe_seconds(strict=True)).withColumn("_s", F.unix_seconds("start"))
    rows = rows.withColumn("_e", F.unix_seconds("end")).where(F.col("_e") > F.col("_s"))
    chunks = F.ceil((F.col("_e") - F.col("_s")) / (F.col("_l") * F.col("_w")))
    rows = rows.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), chunks - 1)).alias("chunk_no"))
    stop = F.col("_e") - F.col("chunk_no") * F.col("_l") * F.col("_w")
    begin = F.greatest(F.col("_s"), stop - F.col("_l") * F.col("_w"))
    return rows.select("pair", "timeframe", "chunk_no", F.timestamp_seconds(begin).alias("chunk_start"),
                       F.timestamp_seconds(stop).alias("chunk_end"),
                       F.least(F.col("_l"), F.floor((stop - begin) / F.col("_w"))).alias("limit"))


def expected_candles(requests, years=3):
    """Bars and requests that `years` of history need; `requests` holds pair, timeframe, exchange."""
    limit = reduce(lambda acc, kv: acc.when(F.col("exchange") == kv[0], F.lit(kv[1])), HISTORIC_LIMITS.items(), F)
    total = bars_per_year() * F.lit(years)
    return requests.select("pair", "timeframe", "exchange", total.alias("expected"),
                           F.ceil(total / limit.otherwise(F.lit(HISTORIC_LIMIT))).alias("chunks"))


def coverage(df, years=3, keys=KEYS):
    """S7 as a report: bars present against bars expected, per series."""
    out = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("actual"))
    out = out.withColumn("expected", bars_per_year() * F.lit(years))
    return out.withColumn("coverage", F.col("actual") / F.col("expected"))


def series_grid(pairs, timeframes=DEFAULT_TIMEFRAMES):
    """Each pair with each timeframe of a short list; `pairs` is a DataFrame with a `pair` column."""
    return pairs.select("pair", F.explode(F.array(*[F.lit(t) for t in timeframes])).alias("timeframe"))

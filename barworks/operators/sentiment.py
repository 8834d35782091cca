"""Text sentiment by lexicon, per day, over a complete calendar."""

from pyspark.sql import functions as F

from barworks.functions.schema import day_key
from barworks.operators.ttl import ttl_get, ttl_row

MEASURES = ("sentiment_mean", "sentiment_std", "subjectivity_mean", "text_count")
_DAY_SALTS = 256
# what stands between words: anything but letters, their marks and apostrophes
_BETWEEN = r"[^\p{L}\p{M}']+"


def _salts(n):
    return F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint"))


def text_sentiment(texts, lexicon, by=("currency", "date", "doc_id")):
    """mean polarity and subjectivity of the lexicon words of a text, 0 when it has none.

    A word meets the lexicon once per text, with its count, and words without an entry go no further. Spark broadcasts
    a small lexicon; with a large one its skew handling splits a word that most texts hold.
    """
    words = texts.select(*by, F.explode(F.split(F.lower("text"), _BETWEEN)).alias("word"))
    counted = words.groupBy(*by, "word").agg(F.count(F.lit(1)).alias("_c"))
    found = counted.join(lexicon, "word").groupBy(*by).agg(F.sum("_c").alias("_n"), *[
        F.sum(F.col("_c") * F.col(c)).alias(c) for c in ("polarity", "subjectivity")])
    means = found.select(*by, *[(F.col(c) / F.col("_n")).alias(c) for c in ("polarity", "subjectivity")])
    return (texts.select(*by).distinct().join(means, list(by), "left")
            .select(*by, *[F.coalesce(c, F.lit(0.0)).alias(c) for c in ("polarity", "subjectivity")]))


def daily_sentiment(scored):
    """A10: mean, population deviation, mean subjectivity and count per currency and day."""
    return scored.groupBy("currency", "date").agg(
        F.avg("polarity").alias("sentiment_mean"), F.stddev_pop("polarity").alias("sentiment_std"),
        F.avg("subjectivity").alias("subjectivity_mean"), F.count(F.lit(1)).alias("text_count"))


def calendar(currencies, start, end):
    """Every day of [start, end] for each currency of a DataFrame."""
    days = F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"), F.expr("interval 1 day"))
    return currencies.select("currency", F.explode(days).alias("date"))


def date_spine(daily, currencies, start, end):
    """One row per currency and day; days without texts hold zeros."""
    rows = calendar(currencies, start, end).join(daily, ["currency", "date"], "left")
    zero = {m: F.lit(0).cast("bigint") if m == "text_count" else F.lit(0.0) for m in MEASURES}
    return rows.select("currency", "date", *[F.coalesce(F.col(m), zero[m]).alias(m) for m in MEASURES])


def cached_days(cache, as_of):
    """K2 for daily values: live cache rows, parsed back into columns."""
    schema = "sentiment_mean double, sentiment_std double, subjectivity_mean double, text_count bigint"
    live = ttl_get(cache, as_of).withColumn("_d", F.from_json("data", schema))
    key = F.col("key")
    return live.select(F.expr("substring(key, 1, length(key) - 11)").alias("currency"),
                       F.to_date(F.right(key, F.lit(10))).alias("date"), *[F.col(f"_d.{m}").alias(m) for m in MEASURES])


def cache_days(daily, now):
    """K1 rows for computed days; days without texts are never cached."""
    data = F.to_json(F.struct(*MEASURES))
    return daily.where("text_count > 0").select(*ttl_row(day_key(), data, now))


def sentiment_features(texts, lexicon, cache, currencies, start, end, as_of):
    """K4: cached days are served, the others computed from their texts, all on the calendar.

    Only texts of days that the cache cannot serve are read.
    """
    wanted = calendar(currencies, start, end)
    served = cached_days(cache, as_of).join(wanted, ["currency", "date"], "left_semi")
    todo = wanted.join(served, ["currency", "date"], "left_anti")
    # one day may hold a large share of all texts: spread it over many join keys
    spread = todo.withColumn("_salt", F.explode(_salts(_DAY_SALTS)))
    fresh = (texts.withColumn("_salt", F.pmod(F.xxhash64(*texts.columns), F.lit(_DAY_SALTS).cast("bigint")))
             .join(spread, ["currency", "date", "_salt"], "left_semi").drop("_salt"))
    computed = daily_sentiment(text_sentiment(fresh, lexicon))
    return date_spine(served.unionByName(computed), currencies, start, end)

"""Row filters and keep-first rules."""

from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F

from barworks.functions import messages as msg
from barworks.functions.schema import KEYS, VALUES


def drop_incomplete(df, columns=None):
    """P5. One condition per column: a single condition over many computed columns multiplies in the optimizer."""
    return df.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns or df.columns]))


def union_all(first, *others):
    """Bag union by column name."""
    return reduce(lambda a, b: a.unionByName(b), others, first)


def distinct_rows(df):
    """Whole-row dedup; copies collapse on the map side, so a hot row does not travel."""
    return df.dropDuplicates()


def keep_first(df, order, by=(*KEYS, "timestamp")):
    """The first row per key in the given order.

    Spark keeps one row per key and task before the shuffle (a window group limit), so many
    copies of one key do not meet in one task.
    """
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("_k", F.row_number().over(w)).where("_k = 1").drop("_k")


def clean_bars(df):
    """Drop duplicate rows, rows with a negative value and rows whose prices contradict (D3)."""
    sound = reduce(lambda a, c: a & (F.col(c) >= 0), VALUES[1:], F.col(VALUES[0]) >= 0)
    ordered = ((F.col("high") >= F.col("low")) & (F.col("high") >= F.col("open")) & (F.col("high") >= F.col("close"))
               & (F.col("low") <= F.col("open")) & (F.col("low") <= F.col("close")))
    return distinct_rows(df.where(sound & ordered))


# Issue name -> text of the message; the conditions follow in `issue_flags`.
ISSUES = {
    "high_below_low": msg.HIGH_BELOW_LOW,
    "high_not_highest": msg.HIGH_NOT_HIGHEST,
    "low_not_lowest": msg.LOW_NOT_LOWEST,
    "bad_volume": msg.BAD_VOLUME,
}


def issue_flags():
    """The four row conditions; a NULL operand is not a hit."""
    hits = {
        "high_below_low": F.col("high") < F.col("low"),
        "high_not_highest": (F.coalesce(F.col("high") < F.col("open"), F.lit(False))
                             | F.coalesce(F.col("high") < F.col("close"), F.lit(False))),
        "low_not_lowest": (F.coalesce(F.col("low") > F.col("open"), F.lit(False))
                           | F.coalesce(F.col("low") > F.col("close"), F.lit(False))),
        "bad_volume": F.col("volume") <= 0,
    }
    return {name: F.coalesce(hit, F.lit(False)) for name, hit in hits.items()}


def first_offenders(df, order=("timestamp",), first=5, keys=KEYS):
    """The first few offending bars per series and issue.

    The row limit reaches the map side, so each task sends at most `first` rows per series and issue.
    """
    flags = issue_flags()
    tagged = df.select("*", F.explode(F.filter(
        F.array(*[F.when(hit, F.lit(name)) for name, hit in flags.items()]), lambda x: x.isNotNull())).alias("issue"))
    w = Window.partitionBy(*keys, "issue").orderBy(*order)
    ranked = tagged.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= first)
    return ranked.select(*keys, "issue", F.col("rank").cast("bigint").alias("rank"), *order)


def consistency_report(df, order=("timestamp",), keys=KEYS):
    """Counts per issue, and a message naming the first offenders; any hit makes the series invalid."""
    flags = issue_flags()
    counts = df.groupBy(*keys).agg(*[F.count_if(hit).alias(f"n_{name}") for name, hit in flags.items()])
    shown = first_offenders(df, order, keys=keys).groupBy(*keys, "issue").agg(F.concat_ws(", ", F.transform(
        F.sort_array(F.collect_list(F.struct("rank", F.date_format(order[0], "yyyy-MM-dd HH:mm:ss").alias("at")))),
        lambda s: s["at"])).alias("shown"))
    text = reduce(lambda acc, kv: acc.when(F.col("issue") == kv[0], F.lit(kv[1])), ISSUES.items(), F)
    order_no = reduce(lambda acc, kv: acc.when(F.col("issue") == kv[1], F.lit(kv[0])), enumerate(ISSUES), F)
    lines = shown.select(*keys, order_no.alias("no"), F.concat(text, F.lit(" at: "), F.col("shown")).alias("line"))
    messages = lines.groupBy(*keys).agg(F.concat_ws("; ", F.transform(
        F.sort_array(F.collect_list(F.struct("no", "line"))), lambda s: s["line"])).alias("message"))
    return (counts.join(messages, list(keys), "left")
            .withColumn("valid", F.col("message").isNull())
            .withColumn("message", F.coalesce("message", F.lit(msg.CONSISTENCY_PASSED))))

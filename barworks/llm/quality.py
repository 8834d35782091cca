"""Quality classifier: a sparse ensemble of rules over text statistics, compiled into Spark column expressions."""

from dataclasses import dataclass

import numpy as np
from pyspark.sql import functions as F

from barworks.llm.common import table

SAMPLE = 20_000  # labelled rows that the rules are fitted on
TREES = 40
DEPTH = 3
LEAST = 10  # rows of a leaf
PENALTIES = (0.01, 0.003, 0.001, 0.0003)
CUTOFF = 0.3

STATISTICS = ("n_chars", "n_words", "word_length", "letters", "capitals", "digits", "signs", "bars", "marks", "stops",
              "different", "lines", "line_words")


def statistics(docs, keep=("doc_id",)):
    """Columns of `keep` and figures of each whole text; a null text counts as empty, whose shares are all 0."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    trimmed = F.btrim("_t", F.lit(" \t\n\x0b\f\r"))
    base = docs.select(*keep, text.alias("_t")).select("*", F.length("_t").alias("n_chars"), trimmed.alias("_trim"))
    base = base.select("*", F.when(F.col("_trim") == "", F.array().cast("array<string>")).otherwise(F.split("_trim", r"\s+")).alias("_w"))
    counts = lambda signs: F.regexp_count("_t", F.lit(signs))
    less = lambda sign: F.col("n_chars") - F.length(F.replace("_t", F.lit(sign), F.lit("")))
    share = lambda part, whole: F.when(whole > 0, part / whole).otherwise(F.lit(0.0))
    counted = base.select(
        *keep, "n_chars", F.size("_w").alias("n_words"), F.size(F.array_distinct("_w")).alias("_different"),
        (F.col("n_chars") - counts(r"\P{L}")).alias("_letters"), counts("[A-ZÀ-ÖØ-Þ]").alias("_capitals"), counts("[0-9]").alias("_digits"),
        counts(r"[!-+\-/:-@\[-`{-~]").alias("_signs"), less("|").alias("_bars"), (less("!") + less("?")).alias("_marks"),
        (less(".") + less(",")).alias("_stops"), (less("\n") + 1).alias("lines"))
    words, chars = F.col("n_words"), F.col("n_chars")
    return counted.select(
        *keep, F.log1p(chars).alias("n_chars"), F.log1p(words).alias("n_words"), share(chars, words).alias("word_length"),
        share(F.col("_letters"), chars).alias("letters"), share(F.col("_capitals"), F.col("_letters")).alias("capitals"),
        share(F.col("_digits"), chars).alias("digits"), share(F.col("_signs"), words).alias("signs"),
        share(F.col("_bars"), words).alias("bars"), share(F.col("_marks"), words).alias("marks"),
        share(F.col("_stops"), words).alias("stops"), share(F.col("_different"), words).alias("different"),
        F.log1p("lines").alias("lines"), share(words, F.col("lines")).alias("line_words"))


def _grow(x, y, columns, depth, path, rules):
    """Split on the column and cut that most reduce the squared error; every node but the root is a rule."""
    if path:
        rules.add(tuple(sorted(path)))
    if depth == 0 or len(y) < 2 * LEAST or y.min() == y.max():
        return
    best = None
    for c in columns:
        order = np.argsort(x[:, c], kind="stable")
        v, sums = x[order, c], np.cumsum(y[order])
        n = np.arange(1, len(y))
        gain = sums[:-1] ** 2 / n + (sums[-1] - sums[:-1]) ** 2 / (len(y) - n)
        gain = np.where((v[1:] > v[:-1]) & (n >= LEAST) & (n <= len(y) - LEAST), gain, -np.inf)
        i = int(np.argmax(gain))
        if gain[i] > -np.inf and (best is None or gain[i] > best[0] + 1e-12):
            best = (gain[i], c, float((v[i] + v[i + 1]) / 2))
    if best is None or best[0] <= y.sum() ** 2 / len(y) + 1e-9:
        return
    _, c, cut = best
    low = x[:, c] <= cut
    _grow(x[low], y[low], columns, depth - 1, [*path, (c, True, cut)], rules)
    _grow(x[~low], y[~low], columns, depth - 1, [*path, (c, False, cut)], rules)


def tree_rules(x, y, trees=TREES, depth=DEPTH, seed=5):
    """The paths of trees grown on halves of the rows and of the columns, as conjunctions of (column, at most, cut)."""
    rng, rules = np.random.default_rng(seed), set()
    for _ in range(trees):
        rows = rng.choice(len(y), max(1, len(y) // 2), replace=False)
        columns = np.sort(rng.choice(x.shape[1], max(1, x.shape[1] // 2), replace=False))
        _grow(x[rows], y[rows], columns, depth, [], rules)
    return sorted(rules)


def holds(rules, x):
    """Which rule holds for which row, as 0 and 1."""
    out = np.ones((len(x), len(rules)))
    for j, rule in enumerate(rules):
        for c, at_most, cut in rule:
            out[:, j] *= (x[:, c] <= cut) if at_most else (x[:, c] > cut)
    return out


def lasso(z, y, penalty, start=None, rounds=1500):
    """Weights and intercept of a logistic regression with an absolute penalty on weights, by proximal gradients."""
    n = max(len(y), 1)
    spread = np.maximum(z.std(0), 1e-9)
    zs = (z - z.mean(0)) / spread
    w, b = (np.zeros(z.shape[1]), 0.0) if start is None else (start[0] * spread, start[1] + start[0] @ z.mean(0))
    step = 4.0 / (np.linalg.norm(np.hstack([zs, np.ones((len(zs), 1))]), 2) ** 2 / n + 1e-9)
    ahead, t = (w, b), 1.0
    for _ in range(rounds):
        error = 1 / (1 + np.exp(-np.clip(zs @ ahead[0] + ahead[1], -40, 40))) - y
        new_w = ahead[0] - step * (zs.T @ error) / n
        new_w = np.sign(new_w) * np.maximum(np.abs(new_w) - step * penalty, 0)
        new_b = ahead[1] - step * error.mean()
        new_t = (1 + np.sqrt(1 + 4 * t * t)) / 2
        pull = (t - 1) / new_t
        change = np.abs(new_w - w).max(initial=0.0) + abs(new_b - b)
        ahead = (new_w + pull * (new_w - w), new_b + pull * (new_b - b))
        w, b, t = new_w, new_b, new_t
        if change < 1e-6:
            break
    weights = w / spread
    return weights, float(b - weights @ z.mean(0))


@dataclass(frozen=True)
class Rules:
    """A fitted ensemble: rules with a weight, and an intercept."""

    rules: tuple
    weights: tuple
    intercept: float

    def column(self):
        """The score as a Spark expression over the statistics."""
        total = F.lit(self.intercept)
        for rule, weight in zip(self.rules, self.weights):
            tests = [F.col(STATISTICS[c]) <= cut if at_most else F.col(STATISTICS[c]) > cut for c, at_most, cut in rule]
            every = tests[0]
            for test in tests[1:]:
                every = every & test
            total = total + F.when(every, F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def fit_rules(x, y):
    """Rules from trees; the penalty is the one with the least log loss on every fifth row, left out meanwhile."""
    if len(y) == 0 or y.min() == y.max():
        share = (y.sum() + 1) / (len(y) + 2)
        return Rules((), (), float(np.log(share / (1 - share))))
    rules = tree_rules(x, y)
    z = holds(rules, x)
    out = np.arange(len(y)) % 5 == 0
    tried, start = [], None
    for penalty in PENALTIES:
        start = lasso(z[~out], y[~out], penalty, start)
        p = np.clip(1 / (1 + np.exp(-np.clip(z[out] @ start[0] + start[1], -40, 40))), 1e-6, 1 - 1e-6)
        tried.append((-np.mean(y[out] * np.log(p) + (1 - y[out]) * np.log(1 - p)), penalty))
    weights, intercept = lasso(z, y, min(tried)[1])
    kept = np.flatnonzero(np.abs(weights) > 1e-4)
    return Rules(tuple(rules[j] for j in kept), tuple(float(weights[j]) for j in kept), intercept)


def fit(docs, labels, may_learn, sample=SAMPLE):
    """Fit on at most `sample` labelled documents that `may_learn` (a Column over doc_id) selects, first by hash of doc_id.

    Of repeated rows of an id one label (the smallest) counts. Null ids and labels and ids without a document teach
    nothing. Without both labels the score is the share of labels.
    """
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
             .where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & F.coalesce(may_learn, F.lit(False)))
             .groupBy("doc_id").agg(F.min("quality").alias("quality"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(known), "doc_id")
    # repeated rows of a sampled id may be many: the first by text stands for them
    rows = (statistics(texts, ("doc_id", "quality")).groupBy("doc_id", "quality")
            .agg(F.min(F.struct(*STATISTICS)).alias("s")).select("doc_id", "quality", "s.*").collect())
    rows.sort(key=lambda r: r.doc_id * 0x9E3779B1 % 2**32)
    x = np.array([[r[s] for s in STATISTICS] for r in rows], dtype=np.float64).reshape(len(rows), len(STATISTICS))
    return fit_rules(x, np.array([float(r.quality > 0) for r in rows]))


def score(docs, rules, cutoff=CUTOFF):
    """One row per document: doc_id, score, predicted. Whole texts are read; an empty or null one has a score too.

    Labels, lang, source and doc_id are no inputs. Repeated rows and ids, and null ids, give a row each; an empty table
    gives none. Nothing moves between tasks.
    """
    scored = statistics(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")).select(
        "doc_id", rules.column().alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= cutoff).cast("int"))


def remainder(n):
    return F.crc32(F.col("doc_id").cast("long").cast("string")) % n


def op8_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    rules = fit(docs, table(spark, sf_dir, "labels"), remainder(5) != 0)
    return score(docs, rules).select("doc_id", F.coalesce(remainder(5) == 0, F.lit(False)).alias("held_out"), "score", "predicted")

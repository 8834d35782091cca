"""Language identification: first the family, then one-versus-one linear support vector machines inside it."""

import re
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from barworks.llm.common import table

# Families of languages by code. A language that is not listed is a family of its own.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca"),
    "slavic": ("ru", "pl", "cs", "uk", "bg", "sr"),
}
UNKNOWN = "und"
PER_LANGUAGE = 400  # rows of a language that the machines are fitted on
MAX_LANGUAGES = 64  # the commonest labels that are learned
FEATURES = 1 << 11
SLICE = 1 << 18  # characters of a text that are counted at a time
_LETTER = re.compile(r"[^\W\d_]")


def features(text):
    """Hashed counts of byte 2-, 3- and 4-grams of the lower-cased text, damped and scaled to length 1."""
    counts = np.zeros(FEATURES)
    for at in range(0, len(text), SLICE):
        b = np.frombuffer((" " + text[at:at + SLICE].lower() + " ").encode("utf-8", "replace"), np.uint8).astype(np.uint32)
        gram = b
        for n in (2, 3, 4):
            gram = gram[:-1] * np.uint32(0x01000193) ^ b[n - 1:]
            mixed = gram * np.uint32(0x9E3779B1)
            counts += np.bincount(mixed >> np.uint32(32 - FEATURES.bit_length() + 1), minlength=FEATURES)
    counts = np.sqrt(counts)
    return counts / max(np.linalg.norm(counts), 1e-12)


def family(lang):
    return next((name for name, members in FAMILIES.items() if lang in members), f"only {lang}")


def support_vectors(x, y, cost=8.0, rounds=60):
    """Weights of a linear support vector machine (squared hinge loss) by dual coordinate descent; y is +1 or -1."""
    x = np.hstack([x, np.ones((len(x), 1))])
    alpha, w = np.zeros(len(x)), np.zeros(x.shape[1])
    # each class counts the same
    weight = np.where(y > 0, 0.5 / max((y > 0).mean(), 1e-9), 0.5 / max((y < 0).mean(), 1e-9)) * cost
    diagonal = (x * x).sum(1) + 0.5 / weight
    order, rng = np.arange(len(x)), np.random.default_rng(7)
    for _ in range(rounds):
        rng.shuffle(order)
        moved = 0.0
        for i in order:
            g = y[i] * (w @ x[i]) - 1 + alpha[i] * 0.5 / weight[i]
            new = max(0.0, alpha[i] - g / diagonal[i])
            if new != alpha[i]:
                w += (new - alpha[i]) * y[i] * x[i]
                moved = max(moved, abs(new - alpha[i]))
                alpha[i] = new
        if moved < 1e-3:
            break
    return w


def duels(x, labels):
    """A machine for each pair of labels: (first, second, weights); positive margins speak for the first."""
    labels = np.array(labels, dtype=object)
    return [(a, b, support_vectors(x[(labels == a) | (labels == b)], np.where(labels[(labels == a) | (labels == b)] == a, 1.0, -1.0)))
            for a, b in combinations(sorted(set(labels)), 2)]


class Model:
    """Machines between families and, for every family, between its languages."""

    def __init__(self, x, langs):
        families = [family(lang) for lang in langs]
        self.members = {f: sorted({g for g, h in zip(langs, families) if h == f}) for f in set(families)}
        self.between = duels(x, families)
        self.within = {f: duels(x[[h == f for h in families]], [g for g, h in zip(langs, families) if h == f])
                       for f in self.members}

    @staticmethod
    def _winner(x, names, machines):
        """The name with most wins, then the larger sum of margins; its least sure duel as a probability."""
        wins, margins, sure = dict.fromkeys(names, 0), dict.fromkeys(names, 0.0), dict.fromkeys(names, 1.0)
        for a, b, w in machines:
            m = float(x @ w[:-1] + w[-1])
            wins[a if m > 0 else b] += 1
            for name, side in ((a, m), (b, -m)):
                margins[name] += side
                sure[name] = min(sure[name], 1 / (1 + np.exp(-3 * max(min(side, 50), -50))))
        best = max(sorted(names), key=lambda n: (wins[n], margins[n]))
        return best, float(sure[best])

    def predict(self, text):
        """(language, score from 0 to 1); the unknown mark and 0 for a null text or one without letters."""
        if not self.members or text is None or not _LETTER.search(text):
            return UNKNOWN, 0.0
        x = features(text)
        chosen, p = self._winner(x, list(self.members), self.between)
        lang, q = self._winner(x, self.members[chosen], self.within[chosen])
        return lang, min(p, q)


def _featured(batches):
    for batch in batches:
        rows = [features(t.as_py()) for t in batch.column(1)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([r.astype("<f4").tobytes() for r in rows], pa.binary())], ["lang", "x"])


def fit(docs, may_learn, per_language=PER_LANGUAGE, max_languages=MAX_LANGUAGES):
    """Fit on labelled rows that `may_learn` (a Column) selects: of each language the `per_language` first by hash of doc_id.

    The sample is bounded by both parameters, and only it reaches the driver. Rows whose lang or text is null or whose
    text has no letters teach nothing. With no row to learn from, every prediction is the unknown mark.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       F.col("lang").cast("string").alias("lang"), may_learn.alias("_may"))
    labelled = docs.where(F.coalesce("_may", F.lit(False)) & F.col("lang").isNotNull() & F.col("doc_id").isNotNull())
    common = labelled.groupBy("lang").count().orderBy(F.col("count").desc(), "lang").limit(max_languages).select("lang")
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = (labelled.select("lang", "doc_id").join(F.broadcast(common), "lang")
              .withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= per_language).select("doc_id").distinct())
    # at most per_language * max_languages ids
    sample = (labelled.join(F.broadcast(chosen), "doc_id").where(F.col("text").rlike(r"\p{L}"))
              .join(F.broadcast(common), "lang").select("lang", "text", "doc_id")
              .withColumn("_n", F.row_number().over(Window.partitionBy("lang").orderBy("doc_id", "text")))
              .where(F.col("_n") <= per_language))
    rows = sample.select("lang", "text").mapInArrow(_featured, "lang string, x binary").collect()
    rows.sort(key=lambda r: (r.lang, bytes(r.x)))
    x = np.array([np.frombuffer(r.x, "<f4") for r in rows], dtype=np.float64).reshape(len(rows), FEATURES)
    return Model(x, [r.lang for r in rows])


def predictor(spark, model, n_columns=1):
    """A function for mapInArrow: keeps the first `n_columns` columns and adds lang_pred and score of the text behind them."""
    shared = spark.sparkContext.broadcast(model)  # bounded by languages and features

    def run(batches):
        for batch in batches:
            found = [shared.value.predict(t.as_py()) for t in batch.column(n_columns)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:n_columns], pa.array([f[0] for f in found], pa.string()),
                 pa.array([f[1] for f in found], pa.float64())],
                [*batch.schema.names[:n_columns], "lang_pred", "score"])
    return run


def identify(docs, may_learn):
    """One row per document: doc_id, lang_pred, score. The language is learned from `may_learn` rows, see `fit`.

    Whole texts are read, long ones in slices. lang, source and doc_id are no inputs. A null text and one without
    letters give `und` and score 0. Repeated rows and ids, and null ids, give a row each; an empty table gives none.
    """
    keep = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    run = predictor(docs.sparkSession, fit(docs, may_learn))
    return keep.mapInArrow(run, "doc_id long, lang_pred string, score double")


def keep_known(docs, may_learn):
    """The documents, all columns, whose text has a language; those identified as `und` go. As `identify` otherwise."""
    # by position, so that no column of the documents can clash
    names = [f"_c{i}" for i in range(len(docs.columns))]
    text = F.col(names[docs.columns.index("text")]).cast("string").alias("_text")
    rows = docs.toDF(*names).select(*names, text)
    schema = ", ".join(f"{n} {f.dataType.simpleString()}" for n, f in zip(names, docs.schema))
    found = rows.mapInArrow(predictor(docs.sparkSession, fit(docs, may_learn), len(names)),
                            f"{schema}, lang_pred string, score double")
    return found.where(F.col("lang_pred") != UNKNOWN).select(*names).toDF(*docs.columns)


def remainder(n):
    return F.crc32(F.col("doc_id").cast("long").cast("string")) % n


def op5_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = identify(docs, remainder(3) != 1)
    return found.select("doc_id", F.coalesce(remainder(3) == 1, F.lit(False)).alias("held_out"), "lang_pred", "score")

import numpy as np
from conftest import SMALL
from llm.conftest import ODD
from pyspark.sql import functions as F

from barworks.llm import common, language, quality


def test_language_of_held_out_rows(spark):
    found = language.op5_language(spark, "/root/testdata/sf0.01")
    truth = common.table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "lang")
    rows = found.where("held_out").join(truth, "doc_id").collect()
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_ignores_other_columns(spark):
    df = common.table(spark, SMALL, "documents")
    fitted = language.fit(df, language.remainder(3) != 1)
    run = language.predictor(spark, fitted, 2)
    texts = df.select("doc_id", "lang", "text")
    a = sorted(texts.mapInArrow(run, "doc_id long, lang string, lang_pred string, score double").collect())
    b = sorted(texts.withColumn("lang", F.lit("zz")).mapInArrow(run, "doc_id long, lang string, lang_pred string, score double").collect())
    assert [(r.doc_id, r.lang_pred, r.score) for r in a] == [(r.doc_id, r.lang_pred, r.score) for r in b]


def test_language_odd_rows(spark, docs):
    df = common.stored(docs([*ODD, (8, "12 345 !!"), (9, "word " * 100000)], lang_pred="clash", score="clash"))
    found = {r.doc_id: (r.lang_pred, r.score) for r in language.identify(df, F.lit(True)).collect()}
    assert found[1] == found[2] == found[3] == found[8] == ("und", 0.0)
    assert found[5][0] == found[9][0] == "en" and len(found) == 8
    kept = language.keep_known(df, F.lit(True))
    assert kept.columns == df.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["5", "5", "6", "9", "None"]
    assert language.identify(docs([]), F.lit(True)).count() == 0
    # nothing to learn from
    assert {r.lang_pred for r in language.identify(df, F.lit(False)).collect()} == {"und"}


def test_families_then_duels():
    rng = np.random.default_rng(0)
    centres = {"en": (3, 0, 0), "de": (3, 3, 0), "fr": (-3, 0, 3), "es": (-3, 0, -3), "xx": (0, -9, 0)}
    langs = [lang for lang in centres for _ in range(40)]
    x = np.array([centres[lang] + rng.normal(0, 0.5, 3) for lang in langs])
    model = language.Model(x, langs)
    assert model.members == {"germanic": ["de", "en"], "romance": ["es", "fr"], "only xx": ["xx"]}
    assert len(model.between) == 3 and [len(model.within[f]) for f in ("germanic", "romance", "only xx")] == [1, 1, 0]
    best, p = model._winner(np.array(centres["de"], float), model.members["germanic"], model.within["germanic"])
    assert best == "de" and 0.5 < p <= 1


def test_quality_of_held_out_rows(spark):
    found = quality.op8_quality(spark, "/root/testdata/sf0.01")
    truth = common.table(spark, "/root/testdata/sf0.01", "labels").select("doc_id", "quality")
    rows = found.where("held_out").join(truth, "doc_id").collect()
    assert np.mean([r.quality == r.predicted for r in rows]) > 0.93
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)


def test_quality_column_is_the_ensemble(spark):
    """The compiled expression gives what the rules give row by row."""
    df = common.table(spark, SMALL, "documents")
    rules = quality.fit(df, common.table(spark, SMALL, "labels"), quality.remainder(5) != 0)
    assert rules.rules
    figures = {r.doc_id: r for r in quality.statistics(df).collect()}
    for r in quality.score(df, rules).collect():
        x = np.array([[figures[r.doc_id][s] for s in quality.STATISTICS]])
        total = rules.intercept + quality.holds(rules.rules, x)[0] @ np.array(rules.weights)
        assert abs(r.score - 1 / (1 + np.exp(-total))) < 1e-12


def test_quality_odd_rows(spark, docs):
    df = docs([*ODD, (9, "word " * 100000)], score="clash", quality="clash", n_words="clash")
    labels = spark.createDataFrame([(1, 0), (5, 1), (5, 0), (None, 1), (6, None), (77, 1), (9, 1), (2, 0)], "doc_id long, quality int")
    found = quality.score(df, quality.fit(df, labels, F.lit(True))).collect()
    assert len(found) == len(ODD) + 1 and all(0 <= r.score <= 1 for r in found)
    none = quality.fit(df, labels.where("false"), F.lit(True))
    assert {r.score for r in quality.score(df, none).collect()} == {0.5}
    assert quality.score(docs([]), none).count() == 0


def test_lasso_drops_what_does_not_help():
    rng = np.random.default_rng(1)
    z = (rng.random((600, 20)) < 0.5).astype(float)
    y = (rng.random(600) < 1 / (1 + np.exp(-(4 * z[:, 0] - 2)))).astype(float)
    w, _ = quality.lasso(z, y, 0.03)
    assert w[0] > 1 and np.count_nonzero(np.abs(w) > 1e-3) <= 4

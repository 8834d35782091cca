import corpus_pipeline
from conftest import SMALL

from barworks.llm import common, decontaminate, simhash
from barworks.llm.catalog import ORACLES, QUERIES


def test_stages_follow_each_other(spark):
    docs = common.table(spark, SMALL, "documents")
    columns, counts = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        docs = common.stored(stage(spark, docs, SMALL))
        counts.append(docs.count())
        if name != "encode":
            assert docs.columns == columns
        if name == "near_duplicates":
            groups = simhash.near_duplicates(docs)
            assert groups.select("component_id").distinct().count() == groups.count()
        if name == "decontaminate":
            assert decontaminate.overlaps(docs, common.table(spark, SMALL, "benchmark")).count() == 0
    assert counts == sorted(counts, reverse=True) and counts[0] > counts[3] > counts[4] > 0.5 * counts[0]
    assert sorted(map(tuple, docs.collect())) == sorted(map(tuple, corpus_pipeline.run(spark, SMALL).collect()))


def test_stages_take_odd_documents(spark, docs):
    from llm.conftest import ODD
    df = common.stored(docs([*ODD, (20, "plain words of a text that has some length"), (21, "<|endoftext|> " * 5000)], _row="clash"))
    for _, stage in corpus_pipeline.STAGES:
        df = common.stored(stage(spark, df, SMALL))
    assert df.count() > 0
    empty = common.stored(docs([]))
    for _, stage in corpus_pipeline.STAGES:
        empty = common.stored(stage(spark, empty, SMALL))
    assert empty.count() == 0 and empty.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_each_operator_has_a_query():
    assert {q.split("_")[0] for q in QUERIES} == {f"op{n}" for n in range(1, 14)} | {"pipeline"}
    assert set(ORACLES) <= set(QUERIES)

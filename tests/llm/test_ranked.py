import math
import re
from collections import Counter

import duckdb
import pytest
from conftest import SMALL
from llm.conftest import ODD

from barworks.llm import common, ranked

TERM = re.compile(ranked.TERM)


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, top=20):
    counts = [(i, Counter(terms(t))) for i, t in docs]
    n_docs, n_words = sum(bool(c) for _, c in counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c in counts:
            n = sum(c.values())
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * ((1000000000 * c[t]) // (1000 * c[t] + 12 * (75 + (25 * n * n_docs) // n_words))) for t in terms(text) if c[t])
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        out += [(item, r, i, -s) for r, (s, _, _, i) in enumerate(sorted(scores)[:top], 1)]
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r[c] for c in ("item_id", "rank", "doc_id", "score")) for r in df.collect()), key=str)


@pytest.mark.parametrize("block_docs", [3, 25, 60_000])
def test_matches_brute_force(spark, docs, prose, monkeypatch, block_docs):
    monkeypatch.setattr(ranked, "BLOCK_DOCS", block_docs)
    monkeypatch.setattr(ranked, "PIECE", 64)
    texts = [(i, prose(5 + 7 * i % 90, i, 60)) for i in range(120)] + [(i, prose(30, 3, 60)) for i in range(120, 150)]
    items = [(i, prose(2 + 3 * i, i, 60)) for i in range(9)] + [(9, prose(4, 1, 60) + " " + prose(4, 1, 60)), (10, "nowhere"), (11, "")]
    df = common.stored(docs(texts).repartition(3))
    got = ranked.search(df, spark.createDataFrame(items, "item_id long, text string"), top=4)
    assert found(got) == brute(texts, items, 4)


def test_odd_rows(spark, docs):
    rows = [*ODD, (8, "\x85Été-ÉTÉ a B  x_y"), (9, "A" * 50_000), (10, "a " * 50_000), (None, "a"), (None, "a text")]
    items = [(1, "A text; without"), (2, None), (3, ""), (4, "été"), (None, "twice TWICE id"), (5, "日本"), (6, "a b"), (6, "a b")]
    df = common.stored(docs(rows, score="clash", rank="clash"))
    got = ranked.search(df, spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string"))
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert found(got) == brute(rows, items)


def test_empty_tables(spark, docs):
    none, some = docs([]), docs([(1, "a b")])
    asked = spark.createDataFrame([(1, "a")], "item_id long, text string")
    for left, right in ((none, asked), (some, asked.where("false")), (docs([(1, None)]), asked)):
        assert ranked.search(common.stored(left), right).count() == 0


def test_matches_its_sql(spark):
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    assert found(ranked.op13_ranked(spark, SMALL)) == sorted(con.sql(ranked.OP13_SQL).fetchall(), key=str)

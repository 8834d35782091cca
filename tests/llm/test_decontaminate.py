import random
from itertools import combinations

import pytest

from barworks.llm import common, decontaminate as dc
from barworks.llm.words import WORD


def split(text):
    return [w for w in WORD.findall((text or "").lower().encode())]


def slow(docs, items):
    """Pairs whose words agree in at least 80 % of a window on some diagonal, by trying every diagonal."""
    out = set()
    for d, text in docs:
        words = split(text)
        for i, item in items:
            own = split(item)
            if len(own) < 5:
                continue
            width = min(20, len(own))
            for offset in range(width - len(own), len(words) - width + 1):
                same = [words[p] == own[p - offset] for p in range(max(0, offset), min(len(words), offset + len(own)))]
                if any(sum(same[a:a + width]) >= 0.8 * width for a in range(len(same) - width + 1)):
                    out.add((d, i))
    return out


@pytest.mark.parametrize("n", range(5, 21))
def test_masks_find_every_tolerated_overlap(n):
    for changed in combinations(range(n), n // 5):
        assert any(all(a + o not in changed for o in mask) for mask in dc.MASKS for a in range(n - mask[-1]))


def test_matches_brute_force(spark, docs, prose):
    rng = random.Random(3)
    items = [(i, prose(rng.randint(5, 60), 100 + i, 5000)) for i in range(12)]
    items += [(50, None), (51, ""), (52, "only four words here"), (53, items[0][1])]
    rows = []
    for d in range(60):
        words = prose(rng.randint(0, 200), d, 5000).split()
        if d % 2:
            copy = rng.choice(items[:12])[1].split()
            for at in rng.sample(range(len(copy)), rng.randint(0, max(1, len(copy) // 4))):
                copy[at] = "changed"
            at = rng.randint(0, len(words))
            words[at:at] = copy
        rows.append((d, ", ".join(words).upper() if d % 3 else " ".join(words)))
    rows += [(100, None), (101, ""), (102, items[1][1] * 3000), (None, items[2][1]), (103, items[3][1]), (103, items[3][1])]
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    df = common.stored(docs(rows, item_id="clash", similarity="clash"))
    found = dc.overlaps(df, bench).collect()
    assert {(r.doc_id, r.item_id) for r in found} == slow(rows, items)
    assert all(r.similarity >= 0.8 for r in found)
    hit = {r.doc_id for r in found}
    kept = dc.keep_clean(df, bench)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(d for d, _ in rows if d not in hit)


def test_blocks_of_the_benchmark(spark, docs, prose, monkeypatch):
    monkeypatch.setattr(dc, "BLOCK_BYTES", 300)
    items = [(i, prose(30, i)) for i in range(8)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = dc.overlaps(docs([(i, t) for i, t in items]), bench)
    assert sorted((r.doc_id, r.item_id) for r in found.collect()) == [(i, i) for i in range(8)]


def test_empty_tables(spark, docs):
    empty = spark.createDataFrame([], "item_id long, text string")
    assert dc.overlaps(docs([(1, "a b c d e f")]), empty).count() == 0
    assert dc.keep_clean(docs([(1, "a b c d e f")]), empty).count() == 1
    assert dc.overlaps(docs([]), empty).count() == 0

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from conftest import SMALL
from llm.conftest import ODD

from barworks.llm import common, hyperminhash


def own_shingles(text, n=3):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for blank in "\t\n\r\x0b\x0c":
        lower = lower.replace(blank, " ")
    words = [w for w in lower.split(" ") if w]
    return {tuple(words[i:i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def brute(rows):
    """(doc_id, size, component, kept) by comparing every pair."""
    sets = [own_shingles(t) for _, t in rows]
    group = list(range(len(rows)))

    def root(x):
        while group[x] != x:
            x = group[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            common_ = len(sets[i] & sets[j])
            if common_ and 100 * common_ >= 85 * len(sets[i] | sets[j]):
                group[root(i)] = root(j)
    out = []
    for i, (doc, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root(j) == root(i) and rows[j][0] is not None]
        first = min(ids, default=None)
        out.append((doc, len(sets[i]), first, doc == first))
    return sorted(out, key=str)


def found(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in df.collect()), key=str)


def edited(text, share, rng):
    words = text.split()
    for i in rng.sample(range(len(words)), max(1, int(share * len(words)))):
        words[i] = f"w{rng.randrange(10 ** 6)}"
    return " ".join(words)


def test_matches_brute_force(spark, docs, prose):
    rng, rows = random.Random(4), []
    for base in range(30):
        text = prose(rng.choice([6, 9, 15, 40, 120, 400]), base)
        rows += [(len(rows) + 1, text)] + [(len(rows) + 2 + i, edited(text, share, rng)) for i, share in enumerate((0.005, 0.02, 0.04, 0.06))]
        rows.append((len(rows) + 1, text.upper().replace(" ", "\n")))
    rng.shuffle(rows)
    assert found(hyperminhash.near_duplicates(common.stored(docs(rows)))) == brute(rows)


def test_odd_rows(spark, docs, prose):
    long = prose(40_000, 3)
    rows = [*ODD, (None, "no id at all here"), (None, "NO ID at all  here"), (8, "a text without an id"), (9, "one"), (4, "ONE"), (10, "one two"),
            (11, "one  two\n"), (12, "one two three"), (20, long), (15, long + " more"), (7, " "), (13, "x\x1cy"), (14, "x y")]
    got = hyperminhash.near_duplicates(common.stored(docs(rows, id="clash", component_id="clash")))
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert found(got) == brute(rows)
    assert hyperminhash.near_duplicates(common.stored(docs([]))).count() == 0
    assert hyperminhash.near_duplicates(common.stored(docs([(1, None), (2, " ")]))).count() == 2


def test_large_group_of_near_copies(spark, docs, prose):
    base, rng = prose(300, 5), random.Random(1)
    rows = [(i, edited(base, 0.01, rng)) for i in range(250)] + [(1000 + i, base) for i in range(300)] + [(2000 + i, prose(50, i)) for i in range(100, 130)]
    assert found(hyperminhash.near_duplicates(common.stored(docs(rows)))) == brute(rows)


@pytest.mark.parametrize("size, shared", [(7, 6), (40, 36), (2000, 1800), (50_000, 45_000)])
def test_estimate_is_near_the_truth(size, shared):
    """Means over many pairs of sets; a small set fills its empty buckets from the others."""
    rng, got = np.random.default_rng(size), []
    for _ in range(60):
        values = rng.integers(0, 1 << 63, 2 * size - shared, dtype=np.uint64) * np.uint64(2)
        a, b = np.unique(values[:size]), np.unique(values[size - shared:])
        got.append(hyperminhash.estimate(hyperminhash.sketch(a)[None], hyperminhash.sketch(b)[None], np.array([size]), np.array([size]))[0])
    assert abs(np.mean(got) - shared / (2 * size - shared)) < 0.03


def test_chance_collisions_are_corrected():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 1 << 63, 5000, dtype=np.uint64) * np.uint64(2)) for _ in range(60)]
    registers = np.stack([hyperminhash.sketch(s) for s in sets])
    agree = np.mean([(registers[i] == registers[j]).mean() for i in range(60) for j in range(i)])
    expected = hyperminhash.expected_collisions(np.array([5000.0]), np.array([5000.0]))[0]
    assert 0.3 * expected < agree < 3 * expected < 0.002


def test_query_on_the_small_tables(spark):
    rows = [(r.doc_id, r.text) for r in common.table(spark, SMALL, "documents").collect()]
    assert found(hyperminhash.op12_hyperminhash(spark, SMALL)) == brute(rows)


def test_registers_are_gone_when_sets_are_compared(spark, docs, prose, monkeypatch):
    """Of the tables in the shared folder only that of the sets to compare may still hold registers."""
    kept, stored_table, links = [], common.stored_table, hyperminhash._links
    monkeypatch.setattr(common, "stored_table", lambda df: kept.append(stored_table(df)) or kept[-1])
    monkeypatch.setattr(hyperminhash, "stored_table", common.stored_table, raising=False)

    def held():
        for path in kept:
            folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            if folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
                yield set(spark.read.parquet(path).columns)

    def spied(*given):
        edges = links(*given)
        assert [c for c in held() if "registers" in c and "hashes" not in c] == []
        return edges
    monkeypatch.setattr(hyperminhash, "_links", spied)
    assert hyperminhash.near_duplicates(docs([(i, prose(60, i // 2)) for i in range(10)])).where("kept").count() == 5
    assert kept


def test_links_come_from_a_table_and_not_from_a_second_worker_in_the_task(spark, docs, prose, monkeypatch):
    plans, links = [], hyperminhash._links

    def spied(*given):
        edges = links(*given)
        plans.append(edges._jdf.queryExecution().toString())
        return edges
    monkeypatch.setattr(hyperminhash, "_links", spied)
    assert hyperminhash.near_duplicates(docs([(i, prose(60, i // 2)) for i in range(10)])).where("kept").count() == 5
    assert len(plans) == 1 and "InArrow" not in plans[0]


def test_comparing_a_block_takes_little_memory():
    """Blocks of 1024 sets against each other: what Python holds beside the sets keeps to some tens of MB."""
    rng = np.random.default_rng(2)
    base = np.unique(rng.integers(0, 1 << 63, 300, dtype=np.uint64) * np.uint64(2))
    sets = [np.unique(np.concatenate((base[i % 7:], rng.integers(0, 1 << 63, 6, dtype=np.uint64) * np.uint64(2)))) for i in range(2048)]
    table = pa.table({"block": np.repeat([0, 1], 1024), "far": np.ones(2048, np.int64), "id": np.arange(2048),
                      "registers": pa.array([hyperminhash.sketch(s).astype("<u2").tobytes() for s in sets], pa.binary()),
                      "hashes": pa.array([s.astype("<u8").tobytes() for s in sets], pa.binary())})
    tracemalloc.start()
    try:
        got = hyperminhash._hangs_together(85)(table)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert got.num_rows == 2047 and peak < 100e6

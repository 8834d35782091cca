import random

import numpy as np
import pytest
import xxhash
from conftest import SMALL
from llm.conftest import ODD
from pyspark.sql import functions as F

from barworks.llm import common, simhash
from barworks.session import shared_folder


def slow_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return 0
    grams = [b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64(g, seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_groups(prints):
    """Smallest id reachable over fingerprints of at most 4 differing bits, from (id, fingerprint) rows."""
    distinct = np.unique(np.array([f for _, f in prints], np.uint64))
    group = list(range(len(distinct)))
    changed = True
    while changed:
        changed = False
        for i in range(len(distinct)):
            for j in np.flatnonzero(np.bitwise_count(distinct ^ distinct[i]) <= 4):
                low = min(group[i], group[j])
                changed |= group[i] != low or group[j] != low
                group[i] = group[j] = low
    number = {int(f): g for f, g in zip(distinct, group)}
    least = {}
    for i, f in prints:
        if i is not None:
            least[number[f]] = min(least.get(number[f], i), i)
    return sorted(((i, f"{f:016x}", least.get(number[f])) for i, f in prints), key=str)


def test_matches_brute_force(spark):
    df = common.table(spark, SMALL, "documents")
    expected = slow_groups([(r.doc_id, slow_fingerprint(r.text)) for r in df.collect()])
    assert sorted((tuple(r) for r in simhash.near_duplicates(df).collect()), key=str) == expected


def test_odd_rows(docs):
    found = sorted((tuple(r) for r in simhash.near_duplicates(docs(ODD, fingerprint="clash", component="clash")).collect()), key=str)
    assert found == slow_groups([(i, slow_fingerprint(t)) for i, t in ODD])
    assert simhash.near_duplicates(docs([])).count() == 0


def test_hot_group_of_near_copies(spark):
    """Hundreds of different fingerprints around one centre, and others: groups as by comparing all pairs."""
    rng = random.Random(4)
    centre = rng.getrandbits(64)
    prints = [centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 6))) for _ in range(400)]
    prints += [rng.getrandbits(64) for _ in range(300)]
    prints += [p ^ 1 << rng.randrange(64) for p in prints[-100:]]
    signed = [p - (1 << 64) if p >= 1 << 63 else p for p in set(prints)]
    items = common.stored(spark.createDataFrame([(p, p, 1) for p in signed], "id long, fp long, n long"))
    found = {r.node: r.component for r in common.near_groups(items, 4, 7).collect()}
    expected = slow_groups([(i, p % (1 << 64)) for i, p in enumerate(signed)])
    ours, theirs = {}, {}
    for i, _, g in expected:
        theirs.setdefault(g, set()).add(i)
        ours.setdefault(found.get(signed[i], signed[i]), set()).add(i)
    assert sorted(map(sorted, ours.values())) == sorted(map(sorted, theirs.values()))


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7)]
    found = {r.node: r.component for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 1 for i in range(1, 61)}, **{i: 100 for i in range(100, 150)}}


def test_components_of_a_long_ordered_chain(spark):
    n = 5000
    chain = spark.range(n - 1).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b")).repartition(8)
    found = common.components(chain).groupBy("component").agg(F.count("*").alias("n")).collect()
    assert [(r.component, r.n) for r in found] == [(0, n)]


def test_components_of_a_chain_that_no_lot_holds(spark, monkeypatch):
    monkeypatch.setattr(common, "EDGES_PER_LOT", 1)
    chain = spark.createDataFrame([(i, i + 1) for i in range(200)], "a long, b long").repartition(50)
    assert {r.component for r in common.components(chain).collect()} == {0}


def test_components_of_a_large_star_and_of_nothing(spark):
    n = 100_000
    star = spark.range(n).select(F.lit(n + 5).alias("a"), F.col("id").alias("b"))
    found = common.components(star).groupBy("component").agg(F.count("*").alias("n")).collect()
    assert [(r.component, r.n) for r in found] == [(0, n + 1)]
    nothing = spark.createDataFrame([(3, 3), (None, 4), (4, None)], "a long, b long")
    assert common.components(nothing).count() == 0


def test_components_against_union_find(spark):
    rng = np.random.default_rng(2)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 400, (300, 2))]
    parent = list(range(400))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in edges:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    expected = {x: root(x) for a, b in edges if a != b for x in (a, b)}
    df = spark.createDataFrame(edges, "a long, b long").repartition(6)
    assert {r.node: r.component for r in common.components(df).collect()} == expected


def test_keep_one_keeps_a_row_of_each_group(docs, prose):
    base = prose(200)
    df = common.stored(docs([(4, base), (3, base), (3, base), (9, base.replace(" a", " b", 1)), (7, prose(200, 9)), (None, "x y")], _row="clash"))
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == [(False, 3), (False, 7), (True, 0)]


def test_keep_one_holds_when_files_are_packed_anew(spark, docs, prose, monkeypatch):
    path, key, keyed_groups = shared_folder(spark), "spark.sql.files.maxPartitionBytes", simhash.keyed_groups
    docs([(i, prose(60, i // 2)) for i in range(40)]).repartition(10, "doc_id").write.parquet(path)
    before = spark.conf.get(key)

    def repack(*given):
        spark.conf.set(key, "1024")  # from here on files are cut and packed as on another number of cores
        return keyed_groups(*given)
    monkeypatch.setattr(simhash, "keyed_groups", repack)
    try:
        spark.conf.set(key, "1g")
        assert sorted(r.doc_id for r in simhash.keep_one(spark.read.parquet(path)).collect()) == list(range(0, 40, 2))
    finally:
        spark.conf.set(key, before)


def test_keep_one_finds_what_brute_force_finds(docs, prose):
    """Copies with words replaced, as by comparing the five-word shingles of all pairs."""
    rng, rows = random.Random(8), []
    for base in range(40):
        rows.append(prose(rng.randint(60, 300), base, 3000))
        for _ in range(2):
            words = rows[-1].split()
            for _ in range(rng.randint(1, 1 + len(words) // 35)):
                words[rng.randrange(len(words))] = "new"
            rows.append(" ".join(words))
    rows += [None, " ", "two words", "Two  WORDS", "two others"]
    sets = []
    for t in rows:
        words = (t or "").lower().split()
        sets.append({tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))})
    group, linked = list(range(len(rows))), []
    for i, a in enumerate(sets):
        for j in range(i):
            share = len(a & sets[j]) / len(a | sets[j])
            if share >= 0.8:
                linked.append(share)
                low, high = sorted((group[i], group[j]))
                group = [low if g == high else g for g in group]
    assert sum(0.8 <= s < 0.9 for s in linked) >= 10
    kept = simhash.keep_one(docs(list(enumerate(rows))))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(group))


def test_keep_one_takes_candidates_by_fingerprints(docs, prose, monkeypatch):
    """The items that are grouped carry SimHash fingerprints, and the keys are bits of these alone."""
    seen, keyed_groups = {}, simhash.keyed_groups

    def spied(items, n_keys, keys_of, close, verify):
        rows = items.toArrow()
        seen["prints"], seen["keys"] = [tuple(r.values()) for r in rows["fp"].to_pylist()], keys_of(rows)
        return keyed_groups(items, n_keys, keys_of, close, verify)
    monkeypatch.setattr(simhash, "keyed_groups", spied)
    texts = [prose(200, 1, 3000), prose(200, 2, 3000)]
    simhash.keep_one(docs(list(enumerate(texts)))).count()
    found = [simhash.wide_fingerprint(simhash.shingles(t, 5)) for t in texts]
    assert sorted(map(tuple, found)) == sorted(seen["prints"])
    assert 200 < np.bitwise_count(found[0] ^ found[1]).sum() < 312
    assert seen["keys"].shape[1] == 2


def test_wide_fingerprints_meet_at_the_least_share():
    """Pairs of sets at exactly 0.8, of a few shingles up to hundreds: within the radius, and in a choice of bits."""
    rng, masks = np.random.default_rng(1), simhash.bit_choices(100_000, 0.8)
    missed = far = 0
    for i in range(300):
        n = (4, 8, 40, 400)[i % 4]
        values = rng.integers(0, 1 << 63, n + n // 4, dtype=np.uint64) * np.uint64(2)
        a, b = (values, values[:n]) if i % 8 < 4 else (values[n // 8:], values[:n + n // 8])
        x, y = (simhash.wide_fingerprint(v).view(np.uint64) for v in (a, b))
        far += np.bitwise_count(x ^ y).sum() > simhash.RADIUS
        missed += not ((x & masks) == (y & masks)).all(axis=1).any()
    assert far == 0 and missed <= 9


@pytest.mark.parametrize("count", [100, 60_000, 4_000_000])
def test_choices_of_bits_miss_no_more_pairs_of_larger_tables(count):
    """Of pairs at the least share, counted with those that differ in more bits than on average."""
    rng, masks = np.random.default_rng(4), simhash.bit_choices(count, 0.8)
    differ = np.arccos(1.6 / 1.8) / np.pi
    bits = np.packbits(rng.random((4000, simhash.BITS)) < differ, axis=1, bitorder="little").view("<u8")
    missed = sum(not (x & masks == 0).all(axis=1).any() for x in bits)
    assert missed <= 12
    assert len(simhash.bit_choices(count, 1)) == 1


def test_no_plan_multiplies_rows(spark):
    plan = simhash.op1_simhash(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_few_links_are_joined_in_few_rounds_and_tasks(spark, monkeypatch):
    """However many partitions a shuffle has, a hot group's links meet in a few lots."""
    rng, written, stored_table = random.Random(3), [], common.stored_table

    def spied(df, **options):
        path = stored_table(df, **options)
        written.append(len(spark.read.parquet(path).inputFiles()))
        return path
    monkeypatch.setattr(common, "stored_table", spied)
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    edges = [(i, rng.randrange(max(0, i - 30), i)) for i in range(1, 600)] + [(i, rng.randrange(i)) for i in range(1, 600)]
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "40")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        found = common.components(spark.createDataFrame(edges, "a long, b long").repartition(40))
        assert {(r.node, r.component) for r in found.collect()} == {(i, 0) for i in range(600)}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert max(written[1:]) <= 2 * spark.sparkContext.defaultParallelism


def test_choices_of_bits_take_turns(spark, docs, prose, monkeypatch):
    """The keys of a part of the choices are shuffled at a time, and every choice has its turn."""
    asked, members = [], common._members
    monkeypatch.setattr(common, "_members", lambda items, n, keys_of: asked.append(n) or members(items, n, keys_of))
    rows = [(i, prose(60, i // 2) + (" more" if i % 2 else "")) for i in range(40)]
    kept = simhash.keep_one(docs(rows)).collect()
    assert sorted(r.doc_id for r in kept) == list(range(0, 40, 2))
    assert len(asked) == 4 and max(asked) <= min(asked) + 1

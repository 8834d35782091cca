import hashlib
import random

import numpy as np
import pytest
from conftest import SMALL
from llm.conftest import ODD

from barworks.llm import common, repeats


def slow(rows):
    """Per row what goes, with a dictionary of all 50-byte strings."""
    data = [(float("inf") if i is None else i, (t or "").encode()) for i, t in rows]
    least = {}
    for i, x in data:
        for a in range(len(x) - 49):
            least[x[a:a + 50]] = min(least.get(x[a:a + 50], i), i)
    out = []
    for (i, x), (doc_id, _) in zip(data, rows):
        gone = np.zeros(len(x), bool)
        for a in range(len(x) - 49):
            if least[x[a:a + 50]] < i:
                gone[a:a + 50] = True
        edges = np.concatenate(([False], gone))
        kept = np.frombuffer(x, np.uint8)[~gone].tobytes()
        out.append((doc_id, len(x), int(gone.sum()), int((edges[1:] & ~edges[:-1]).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def test_matches_brute_force_on_documents(spark):
    df = common.table(spark, SMALL, "documents")
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    assert sorted(map(tuple, repeats.removal_digest(df).collect()), key=str) == slow(rows)


@pytest.mark.parametrize("small", [False, True])
def test_matches_brute_force_on_passages(spark, docs, prose, monkeypatch, small):
    """Passages of 40 to 200 bytes dealt over texts, periodic runs, copies, slices of long texts, many blocks and buckets."""
    if small:  # one task reads in this process's memory, so the sizes reach it only through the parameters of the plan
        monkeypatch.setattr(repeats, "BLOCK_BYTES", 3000)
        monkeypatch.setattr(repeats, "BUCKET_BYTES", 1000)
    rng = random.Random(6)
    passages = [prose(60, s)[:rng.choice([40, 49, 50, 51, 60, 120, 200])] for s in range(15)]
    rows = []
    for d in rng.sample(range(1000), 60):
        text = prose(rng.randint(0, 40), d)
        for _ in range(rng.randint(0, 3)):
            at = rng.randint(0, len(text))
            text = text[:at] + rng.choice(passages) + text[at:]
        rows.append((d, text))
    rows += [(1, "be " * 60), (2, "x" + "be " * 40), (3, "é" * 80), (4, "é" * 79), *ODD, (None, passages[-1] * 2), (2000, rows[0][1])]
    df = common.stored(docs(rows, block="clash", bucket="clash"))
    assert sorted(map(tuple, repeats.removal_digest(df).collect()), key=str) == slow(rows)


def test_slices_of_a_long_text(monkeypatch, prose):
    """Each judged string starts in exactly one slice, at its place."""
    text = prose(2000).encode()
    whole = next(repeats._parsed([text]))[3]
    strings = {(int(a), int(k)) for f, b, k in zip(whole.first, whole.last, whole.keys) for a in range(f, b + 1)}
    monkeypatch.setattr(repeats, "LOT_BYTES", 700)
    cut = []
    for _, _, offsets, parse in repeats._parsed([text]):
        cut += [(int(a) + offsets[0], int(k)) for f, b, k in zip(parse.first, parse.last, parse.keys) for a in range(f, b + 1)]
    assert len(cut) == len(set(cut)) and set(cut) == strings


def test_empty_table_and_kept_bytes(docs, prose):
    assert repeats.removal_digest(docs([])).count() == 0
    text = prose(30)
    kept = {r.doc_id: bytes(r.kept) for r in repeats.remove_repeats(docs([(1, text), (2, "before " + text)])).collect()}
    assert kept == {1: text.encode(), 2: b"before "}

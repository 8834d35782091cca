import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from conftest import SMALL
from llm.conftest import ODD
from tokenizers import Tokenizer

from barworks.llm import alignment, common

PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def tools():
    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PATHS[1])


def spans(ids, spelling):
    out, at = [], 0
    for i in ids:
        out.append((at, at + len(spelling(i)), i))
        at = out[-1][1]
    return out


def brute(rows, tools):
    """Every pair of tokens compared, whole texts through the libraries."""
    a, b = tools
    signs = alignment.bytes_of_signs()

    def spell_a(i):
        return bytes(signs[c] for c in a.id_to_token(i))

    def spell_b(i):
        piece = b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()
    found = []
    for _, text in rows:
        ids_a = a.encode(" " + (text or ""), add_special_tokens=False).ids
        ids_b = b.encode(text or "")
        full = (" " + (text or "")).encode()
        if not text or b"".join(map(spell_a, ids_a)) != full or b"".join(map(spell_b, ids_b)) != full:
            found.append(None)
            continue
        sa, sb = spans(ids_a, spell_a), spans(ids_b, spell_b)
        ends = sorted({e for _, e, _ in sa} & {e for _, e, _ in sb})
        links, start = [], 0
        for s, e, i in sa:
            while sb[start][1] <= s:
                start += 1
            at = start
            while at < len(sb) and sb[at][0] < e:
                links.append((i, sb[at][2]))
                at += 1
        groups, left = [], 0
        for end in ends:
            groups.append("|".join(",".join(str(i) for s, e, i in side if left <= s and e <= end) for side in (sa, sb)))
            left = end
        found.append((len(sa), len(sb), len(ends), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    count = Counter(pair for f in found if f for pair in set(f[3]))
    best = {}
    for (i, _), n in count.items():
        best[i] = max(best.get(i, 0), n)
    out = []
    for (doc, _), f in zip(rows, found):
        if f is None:
            out.append((doc, 0, 0, 0, 0, 0, 0, ""))
        else:
            out.append((doc, *f[:3], len(f[3]), sum(count[p] == best[p[0]] for p in f[3]), sum(count[p] for p in f[3]), f[4]))
    return sorted(out, key=str)


def found(df):
    assert df.columns == COLUMNS
    return sorted((tuple(r) for r in df.collect()), key=str)


STRANGE = ["<|endoftext|> and </s> are text", "a▁b", "  two  blanks ", "\n\n a\tb\r\n", "日本語のテキスト and latin", "🙂🙃 x", "don't 'tis", "é" * 40,
           "x" * 500, " ", "a\x00b�", " nbsp em", "1234567 89", "ࡰ new letters \U00010d50", "é combining", "a  "]


def test_matches_brute_force(spark, docs, prose, tools, monkeypatch):
    monkeypatch.setattr(alignment, "SLICE", 50)
    rows = [*ODD, *((100 + i, t) for i, t in enumerate(STRANGE)), (None, "a▁b")]
    rows += [(200 + i, prose(20 + i, i % 7)) for i in range(30)] + [(300 + i, prose(25, 3)) for i in range(5)]
    df = common.stored(docs(rows, key="clash", n_a="clash"))
    assert found(alignment.measures(df, *PATHS)) == brute(rows, tools)


def test_many_blocks_and_buckets(spark, docs, prose, tools, monkeypatch):
    """Workers that start anew read the module again, so blocks and buckets are made small through its functions."""
    monkeypatch.setattr(alignment, "PER_BUCKET", 50)
    rows = [(i, prose(40, i % 40)) for i in range(90)]
    df = common.stored(docs(rows).repartition(7))
    assert found(alignment.measures(df, *PATHS)) == brute(rows, tools)


def test_empty_tables(spark, docs):
    assert alignment.measures(common.stored(docs([])), *PATHS).count() == 0
    assert found(alignment.measures(common.stored(docs([(3, None), (3, "")])), *PATHS)) == [(3, 0, 0, 0, 0, 0, 0, "")] * 2


def test_pieces_are_cut_where_the_libraries_cut(tools):
    both, rng = alignment.Tokenizers(*PATHS), random.Random(5)
    signs = "ab  ,.'\n\tsé日🙂1  <|>"
    for _ in range(400):
        text = "".join(rng.choice(signs) for _ in range(rng.randrange(1, 60)))
        a, b = both.encode(text)
        assert a.tolist() == tools[0].encode(" " + text, add_special_tokens=False).ids
        assert b.tolist() == tools[1].encode(text)


def test_groups_spell_the_text(spark, docs):
    rows = [(1, "Alignment of unlike tokenizers, für alle"), (2, "Alignment of unlike tokenizers, für alle"), (3, None)]
    (row,) = alignment.groups(common.stored(docs(rows)), *PATHS).collect()
    both = alignment.Tokenizers(*PATHS)
    assert row.copies == 2 and len(row.a) == len(row.b) > 3
    for a, b in zip(row.a, row.b):
        assert b"".join(both.bytes_a[i] for i in a) == b"".join(both.bytes_b[i] for i in b)


def test_query_on_the_small_tables(spark, tools):
    rows = [(r.doc_id, r.text) for r in common.table(spark, SMALL, "documents").collect()]
    assert found(alignment.op11_alignment(spark, SMALL)) == brute(rows, tools)


def test_texts_are_tokenised_once(spark, docs, prose, tools, monkeypatch):
    """Links, not texts, wait for the counts; packed and unpacked they are the same."""
    tables, stored = [], alignment.stored
    monkeypatch.setattr(alignment, "stored", lambda df, **options: tables.append(df.columns) or stored(df, **options))
    df = common.stored(docs([(i, prose(20, i % 7)) for i in range(20)]))
    assert alignment.measures(df, *PATHS).count() == 20
    assert "links" in tables[0] and not any("text" in c for columns in tables for c in columns)
    rng = np.random.default_rng(1)
    links = [rng.integers(0, 1 << 32, n, dtype=np.uint32) for n in (1, 300, 7)]
    keys, ends, flat = alignment._unpacked_links(alignment._packed_links([bytes([i]) * 32 for i in range(3)], links))
    assert keys == [bytes([i]) * 32 for i in range(3)] and ends.tolist() == [1, 301, 308] and (flat == np.concatenate(links)).all()

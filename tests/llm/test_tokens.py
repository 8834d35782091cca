import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex
from llm.conftest import ODD
from tokenizers import Tokenizer

from barworks.llm import bpe, common, token_counts

WORDS, BYTES = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json"))
PIECES = ["a", "the", "ing", " ", "  ", "\n", "\t", "é", "é", "日本", "🙂", "'s", "'LL", "12", "½", ".", "!!", "<|endoftext|>",
          "<|startoftext|>", "\x1c", "\x85", " ", "　", "İ", "ΑΣ", "ا", "​", "----", "x" * 60]


def mixes(n, seed):
    rng = random.Random(seed)
    return [(i, "".join(rng.choice(PIECES) for _ in range(rng.randint(0, 40)))) for i in range(n)]


def test_counts_are_the_librarys(spark, docs, monkeypatch):
    rows = [*mixes(300, 1), *[(1000 + (i or 0), t) for i, t in ODD]]
    library = Tokenizer.from_file(WORDS)
    expected = sorted((i, len((t or "").encode()), n := len(library.encode(t or "", add_special_tokens=False).ids), n > 30) for i, t in rows)
    df = common.stored(docs(rows, word="clash", n_tokens="clash"))
    assert sorted(tuple(r) for r in token_counts.token_counts(df, WORDS, 30).collect()) == expected


def test_postings_hold_every_count(spark, docs, prose):
    rows = [*[(i, prose(50, i)) for i in range(20)], (20, "word " * 100000), (21, "<|endoftext|>" * 3)]
    block, names = token_counts._Postings(WORDS), token_counts._Names(WORDS)
    for i, t in rows:
        block.add(i, t)
        names.add(i, t)
    made = list(block.batches())
    words = [w for b in made for w in b.column(1).to_pylist()]
    assert sorted(words) == sorted(w for b in names.batches() for w in b.column(0).to_pylist())
    ones = [b.append_column("pieces", pa.array([1] * b.num_rows)).select(["block", "docs", "pieces"]) for b in made]
    total = np.frombuffer(next(token_counts._sums(iter(ones))).column(1)[0].as_py(), "<i8")
    assert total.tolist() == [50] * 20 + [100000, 3]
    assert token_counts.token_counts(docs([]), WORDS).count() == 0


def test_plain_cuts_are_the_librarys():
    tok, cut = token_counts._tokenizer(WORDS), token_counts._cutter(WORDS)
    rng = random.Random(9)
    for _ in range(3000):
        chunk = "".join(chr(rng.choice([rng.randrange(33, 127), rng.randrange(33, 0x260), 39])) for _ in range(rng.randint(1, 9)))
        normal = tok.normalizer.normalize_str(chunk)
        assert list(cut(chunk)) == [w for w, _ in tok.pre_tokenizer.pre_tokenize_str(normal)]


def test_blocks_of_postings_are_bounded_by_their_text():
    block = token_counts._Postings(WORDS)
    block.add(0, "word " * 3_000_000)
    assert not block.full()
    block.add(1, "word " * 400_000)
    assert block.full()


def test_runs_of_letters_are_cut_without_the_pattern(monkeypatch):
    """A chunk of letters is its own pre-token, for which the pattern need not be searched."""
    searched, compiled = [], regex.compile

    class Spied:
        def __init__(self, pattern):
            self.find = compiled(pattern).findall

        def findall(self, text):
            searched.append(text)
            return self.find(text)
    monkeypatch.setattr(token_counts.regex, "compile", Spied)
    cut, tok = token_counts._cutter.__wrapped__(WORDS), token_counts._tokenizer(WORDS)
    chunks = ["Words", "\u00c4rger", "it's", "\u0130x", "a1", "don", "\u01c5\u02b0"]
    for chunk in chunks:
        assert list(cut(chunk)) == [w for w, _ in tok.pre_tokenizer.pre_tokenize_str(tok.normalizer.normalize_str(chunk))]
    assert searched == ["it's", "\u0130x".lower(), "a1"]


def test_documents_get_a_bounded_number_of_sums(spark, docs, prose, monkeypatch):
    """What a slot sums up are the documents of its own blocks, so all sums together grow with the documents and not with their square."""
    monkeypatch.setattr(token_counts, "GROUP_BLOCKS", 2)
    monkeypatch.setattr(token_counts, "SLOTS", 3)
    rows = [(i, prose(40, i)) for i in range(240)]
    library, totals, seen = Tokenizer.from_file(WORDS), token_counts._totals, spark.sparkContext.accumulator(0)

    def counted(found):
        seen.add(found.num_rows)
        return totals(found)
    monkeypatch.setattr(token_counts, "_totals", counted)
    df = common.stored(docs(rows).repartition(4))
    settings = {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    found = {r.doc_id: r.n_tokens for r in token_counts.token_counts(df, WORDS).collect()}
    for k, v in before.items():
        spark.conf.set(k, v)
    assert found == {i: len(library.encode(t, add_special_tokens=False).ids) for i, t in rows}
    assert 0 < seen.value <= 3 * 4  # SLOTS rows a block at most, however many tasks share the pre-tokens


def test_ids_are_the_librarys():
    library, merges = Tokenizer.from_file(BYTES), bpe.merge_list(BYTES)
    for _, text in mixes(1500, 2):
        ids = np.frombuffer(b"".join(bpe.encode_stream(text, merges)), "<u4").tolist()
        assert ids == library.encode(text, add_special_tokens=False).ids
        assert "".join(bpe.decode_stream([np.array(ids, "<u4").tobytes()], merges)) == text


@pytest.mark.parametrize("text", ["a" * 30000, "ab" * 9000, "=-" * 5000 + "=" * 9000, " " * 12000, "abcdefgh" * 2000, "é" * 9000])
def test_long_pre_tokens_stream(text):
    """Tokens leave the window long before the end, and are those of the whole."""
    library, merges = Tokenizer.from_file(BYTES), bpe.merge_list(BYTES)
    assert bpe.encode_pre_token(text.encode(), merges) == library.encode(text, add_special_tokens=False).ids
    machine, most = bpe.Transducer(merges), 0
    for at in range(0, len(text), 1000):
        machine.feed(text[at:at + 1000].encode())
        machine.stable()
        most = max(most, len(machine.last))
    assert most <= 4 * merges.lookahead


def test_decoder_state_crosses_blocks():
    merges = bpe.merge_list(BYTES)
    ids = np.frombuffer(b"".join(bpe.encode_stream("🙂日本", merges)), "<u4")
    assert "".join(bpe.decode_stream([i.tobytes() for i in ids], merges)) == "🙂日本"
    broken = np.array([merges.tokens[b"\xf0"], merges.tokens[b"a"]], "<u4")
    assert "".join(bpe.decode_stream([broken.tobytes()], merges)) == "�a"


def test_slices_do_not_change_ids(monkeypatch, prose):
    merges, text = bpe.merge_list(BYTES), prose(3000) + "  \n\n " + prose(500)
    whole = b"".join(bpe.encode_stream(text, merges))
    monkeypatch.setattr(bpe, "SLICE", 200)
    assert b"".join(bpe.encode_stream(text, merges)) == whole


def test_round_trip_rows(spark, docs):
    rows = [*mixes(60, 3), *ODD]
    library = Tokenizer.from_file(BYTES)

    def expected(i, t):
        ids = library.encode(t or "", add_special_tokens=False).ids
        return (i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest())

    df = docs(rows, ids="clash")
    assert sorted(map(tuple, bpe.round_trip(df, BYTES).collect()), key=str) == sorted((expected(*r) for r in rows), key=str)
    back = bpe.decode(bpe.encode(df, BYTES), BYTES)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(rows, key=str)
    assert bpe.round_trip(docs([]), BYTES).count() == 0

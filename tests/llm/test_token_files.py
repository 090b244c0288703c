import zlib

import corpus
import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from strata.llm import crc, rans, token_files as t11
from strata.llm.tokens import TokenCoder, coder
from tokenizers import Tokenizer

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)

ODD = [
    "", " ", "it's I'LL 'tis don't", "<|endoftext|> a<|startoftext|>b < | >", "a b c\x1cd\x85e", "é ́x ﬁ Ǆ İ ẞ ß ÿ Ÿ",
    "ΑΣ ΑΣ. Σ", "x²½ 12345 1.5e-3 ٣", "日本語 テキスト 한국어", "😀👍🏽 a😀b", "A_b-c__d \\ ~`^[]{}|", "\r\n\ttabs\x0bvertical\x0cfeed", "Ünïcödé ÀÉÎ×÷", "a" * 500,
]


def ids_of(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", ODD + [r[1] or "" for r in corpus.awkward()][:60])
def test_word_by_word_equals_the_library(text):
    own = coder(PATH)
    assert own.wordwise
    assert np.frombuffer(own.encode([text])[0], own.dtype).tolist() == ids_of(text)


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from("aB'sé <|>\n. 1́ß")), max_size=40))
def test_any_text_equals_the_library(text):
    own = coder(PATH)
    assert np.frombuffer(own.encode([text])[0], own.dtype).tolist() == ids_of(text)


def test_other_tokenizers_encode_whole_texts():
    path = public_tokenizers.path("byte_bpe_50k.json")
    own, library = TokenCoder(path), Tokenizer.from_file(path)
    assert not own.wordwise
    assert [np.frombuffer(x, own.dtype).tolist() for x in own.encode(ODD)] == [library.encode(x, add_special_tokens=False).ids for x in ODD]


def test_memory_is_bounded():
    own = TokenCoder(PATH)
    own.words.most = own.pieces.most = 5
    text = "one two three four five six seven eight one two"
    assert np.frombuffer(own.encode([text])[0], own.dtype).tolist() == ids_of(text)
    assert max(map(len, (own.words, own.pieces))) <= 5


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=60), st.binary(max_size=300))
def test_crc_of_joined_parts(a, b):
    whole, own, more = zlib.crc32(a + b), zlib.crc32(a), zlib.crc32(b)
    assert crc.carried_far(own, len(b)) ^ more == whole
    assert int(crc.carried(np.array([own], np.uint32), np.array([len(b)]), 300)[0]) ^ more == whole


def made(symbols):
    return rans.Table(rans.frequencies(np.bincount(symbols)))


@pytest.mark.parametrize("n", [1, rans.LANES, rans.LANES * rans.STEPS, rans.LANES * rans.STEPS + 1, rans.BLOCK, rans.BLOCK * 2 + 77])
@pytest.mark.parametrize("spread", [1, 2, 300, 60_000])
def test_round_trip(n, spread):
    symbols = np.random.default_rng(n + spread).zipf(1.4, n) % spread
    table = made(symbols)
    blocks = [symbols[a : a + rans.BLOCK] for a in range(0, n, rans.BLOCK)]
    data = rans.encode(blocks, table)
    assert [x.tolist() for x in rans.decode(data, table)] == [x.tolist() for x in blocks]
    for a, b in [(0, 1), (n // 3, n // 3 + 9000), (n - 1, n), (5, 5)]:
        assert rans.decode_range(data[0], table, a, b).tolist() == blocks[0][a:b].tolist()


def test_frequencies():
    counts = np.array([10**12, 0, 1, 5, 10**6])
    parts = rans.frequencies(counts)
    assert parts.sum() == 1 << rans.SCALE and (parts[counts > 0] > 0).all() and parts[1] == 0
    assert not rans.frequencies(np.zeros(3, int)).any() and not len(rans.frequencies(np.zeros(0, int)))


def test_size_is_near_the_entropy():
    symbols = np.random.default_rng(1).zipf(1.3, rans.BLOCK) % 5000
    p = np.bincount(symbols) / len(symbols)
    bits = -(p[p > 0] * np.log2(p[p > 0])).sum()
    assert len(rans.encode([symbols], made(symbols))[0]) * 8 / len(symbols) < bits + 0.4


def test_damage_is_seen():
    symbols = np.arange(5000) % 97
    table = made(symbols)
    data = rans.encode([symbols], table)[0]
    for at in (0, 10, 60, len(data) // 2, len(data) - 1):
        with pytest.raises(rans.Damaged):
            rans.decode([data[:at] + bytes([data[at] ^ 4]) + data[at + 1 :]], table)
    with pytest.raises(rans.Damaged):
        rans.decode([data[:-9]], table)
    other = rans.Table(rans.frequencies(np.bincount(symbols) + np.arange(97)))
    with pytest.raises(rans.Damaged):
        rans.decode([data], other)


def expected(rows):
    """Documents by id; of the same id in any order of their texts."""
    out = {}
    for doc_id, text, *_ in rows:
        ids = ids_of(text or "") + [1]
        out.setdefault(doc_id, []).append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    return out


def check(got, rows):
    want = expected(rows)
    found = {}
    for r in got:
        found.setdefault(r["doc_id"], []).append((r["n_tokens"], r["ids_crc32"]))
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in want.items()}
    at = 0
    for r in sorted(got, key=lambda r: r["start"]):
        assert r["start"] == at
        at += r["n_tokens"]
    ids = [r["doc_id"] for r in sorted(got, key=lambda r: r["start"])]
    assert ids == sorted(ids, key=lambda x: -1 if x is None else x)


@pytest.fixture
def small_blocks(monkeypatch):
    """Long documents span many blocks and groups."""
    monkeypatch.setattr(t11, "GROUP", 1)


def test_query_equals_brute_force(spark, tmp_path, small_blocks):
    rows = corpus.awkward() + [(7000, corpus.text_of(__import__("random").Random(5), 12_000), "en", "a", 1)] + [(8, "the same row", "en", "a", 1)] * 40
    corpus.frame(spark, rows, clash=True).write.parquet(f"{tmp_path}/documents.parquet")
    check(t11.op11_token_files(spark, str(tmp_path)).collect(), rows)


def test_ranges(spark, tmp_path):
    rows = [(i, f"document {i} says {corpus.prose(__import__('random').Random(i), 400)}", "en", "a", 1) for i in range(150)]
    t11.write_tokens(corpus.frame(spark, rows), f"{tmp_path}/out", PATH)
    whole = [x for r in rows for x in ids_of(r[1]) + [1]]
    for a, b in [(0, 10), (len(whole) // 2 - 20_000, len(whole) // 2 + 20_000), (len(whole) - 5, len(whole) + 100)]:
        pieces = t11.read_range(spark, f"{tmp_path}/out", a, b).orderBy("start").collect()
        assert [x for p in pieces for x in p["ids"]] == whole[a:b] and pieces[0]["start"] == a


def test_damaged_file_raises(spark, tmp_path):
    t11.write_tokens(corpus.frame(spark, corpus.awkward()[:20]), f"{tmp_path}/out", PATH)
    blocks = spark.read.parquet(f"{tmp_path}/out/blocks")
    at = F.length("payload") - 20
    bad = F.concat(F.expr("substring(payload, 1, length(payload) - 20)"), F.lit(b"\x07"), F.expr("substring(payload, length(payload) - 18, 19)"))
    blocks.withColumn("payload", F.when(at > 0, bad)).write.parquet(f"{tmp_path}/bad/blocks")
    spark.read.parquet(f"{tmp_path}/out/table").write.parquet(f"{tmp_path}/bad/table")
    with pytest.raises(Exception, match="checksum"):
        t11.read_documents(spark, f"{tmp_path}/bad").collect()


def test_empty(spark, tmp_path):
    corpus.frame(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    assert t11.op11_token_files(spark, str(tmp_path)).collect() == []

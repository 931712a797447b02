"""BPE against the tokenizers library, packing against its contract."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from takepick.llm.bpe import SegmentTreeBPE, bpe_round_trip, segment_tree
from takepick.llm.packing import fillings, nnls, pack, pack_block
from takepick.llm.tokens import default_tokenizer, library_ids, load

ODD = [
    None, "", " ", "a", "Hello, World!", "it's we'll I'M they'd", "x\x1cy \x1f z", "a\xa0b c\x85d", "<|endoftext|>", "a<|startoftext|>b <|endoftext|>!",
    "<|ENDOFTEXT|>", "É é é ñ ﬁ ΟΔΟΣ İstanbul ǅ", "日本語 テスト 한국어", "🙂🙂 👩‍👩‍👧 ½ ٣", "123 4567 1,000.5", "\n\t\r\v\f", "word" * 5000, "!" * 3000, "́ x ́",
    "a\x00b", "​zero‍width", "'S 'T's't", "ünïcödé—dash “quotes”", "𝔘𝔫𝔦", "﻿bom",
]


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, ids string")


def expected(texts):
    t = load(default_tokenizer())
    return [e.ids for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)], t


def test_segment_tree_equals_library(spark):
    want, library = expected(ODD)
    got = {r.doc_id: r for r in bpe_round_trip(frame(spark, ODD), default_tokenizer()).collect()}
    for i, ids in enumerate(want):
        assert got[i].ids == ids, ODD[i]
        assert got[i].decoded == library.decode(ids, skip_special_tokens=False)


def test_segment_tree_equals_library_on_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    want, library = expected([r.text for r in rows])
    got = {r.doc_id: r for r in bpe_round_trip(docs, default_tokenizer()).collect()}
    for r, ids in zip(rows, want):
        assert got[r.doc_id].ids == ids
        assert got[r.doc_id].decoded == library.decode(ids, skip_special_tokens=False)


def test_every_character_alone_and_between_letters():
    library = load(default_tokenizer())
    texts = [f"a{chr(c)}b {chr(c)} {chr(c)}, A{chr(c)}!" for c in [*range(0x3100), *range(0xA000, 0xD800, 7), *range(0xE000, 0x1F700, 11)]]
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    for ids_of in (segment_tree(default_tokenizer())[1], library_ids(default_tokenizer())):
        for text, ids, expected_ids in zip(texts, ids_of(pa.array(texts)), want):
            assert ids.tolist() == expected_ids, ascii(text)


def test_marks_and_mixed_case_around_words():
    rng = random.Random(41)
    parts = ["Word", "ÉTÉ", "ıI", "İ", "ΟΔΟΣ", "naïve", "ß", "中文", "ab1", "'s", "don't", "&&&", ",$$$", "...", "'", "!?", "\u0301", "e\u0301", "<|endoftext|>", "_a_", "½", "ﬁ"]
    texts = [rng.choice(["", " ", "\n"]).join(rng.choice(parts) + rng.choice(["", " ", ", "]) for _ in range(rng.randrange(12))) for _ in range(3000)]
    want = [e.ids for e in load(default_tokenizer()).encode_batch(texts, add_special_tokens=False)]
    for ids_of in (segment_tree(default_tokenizer())[1], library_ids(default_tokenizer())):
        for at in range(0, 3000, 250):
            for text, ids, expected_ids in zip(texts[at:], ids_of(pa.array(texts[at : at + 250])), want[at:]):
                assert ids.tolist() == expected_ids, ascii(text)
    assert library_ids(default_tokenizer())(pa.array([None, "", " "], pa.string()))[0].tolist() == [] and library_ids(default_tokenizer())(pa.array([], pa.string())) == []


def test_long_word_takes_logarithmic_updates():
    bpe = SegmentTreeBPE(default_tokenizer())
    word = "abcdefghij" * 20_000
    ids = bpe.word(word)
    assert ids == load(default_tokenizer()).encode(word, add_special_tokens=False).ids


def check_packing(spark, texts, window, **kw):
    want, _ = expected(texts)
    rows = pack(frame(spark, texts), default_tokenizer(), window=window, **kw).collect()
    docs, sequences = {}, {}
    for r in rows:
        docs.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    assert set(docs) == set(range(len(texts)))
    for i, ids in enumerate(want):
        at = 0
        for r in sorted(docs[i], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids) + 1
            assert np.frombuffer(r.ids, "<u4").tolist() == [*ids, 1][at : at + r.length]
            at += r.length
        assert at == len(ids) + 1
    padding = 0
    for s in sequences.values():
        at = 0
        for r in sorted(s, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= window
        padding += 0 if at & (at - 1) == 0 else window - at
    assert padding == 0
    return rows


def test_packing_contract(spark):
    texts = [*ODD, *("w " * n for n in (1, 7, 15, 16, 31, 63, 64, 65, 100, 127, 128, 129, 1000))] * 3
    check_packing(spark, texts, 64, unit=4, block_tokens=500)


def test_packing_one_length(spark):
    check_packing(spark, ["w " * 40] * 200, 64, unit=4)


def test_packing_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").collect()
    check_packing(spark, [r.text for r in docs], 2048)


def test_packing_empty(spark):
    assert pack(frame(spark, []), default_tokenizer()).collect() == []
    with pytest.raises(ValueError):
        pack(frame(spark, []), default_tokenizer(), window=100)


def test_nnls_meets_its_optimality_conditions():
    rng = np.random.default_rng(0)
    for _ in range(20):
        a, b = rng.random((12, 30)), rng.random(12) * 10
        x = nnls(a, b)
        g = a.T @ (b - a @ x)
        assert (x >= 0).all() and (g <= 1e-6).all() and np.abs(g[x > 0]).max() < 1e-6


def test_combinations_use_up_a_matching_histogram():
    assert (fillings(8, 3).T @ np.arange(1, 9) == 8).all()
    pieces = [(i, 0, n) for i, n in enumerate([24] * 50 + [40] * 50 + [16, 16, 32] * 30)]
    full, left = pack_block(pieces, 64, 8, 3)
    assert not left and len(full) == 80 and all(len(s) <= 3 for s in full)


def test_ids_digest_format(spark):
    from takepick.llm.queries import op1_packing, op3_bpe

    sf = "/root/testdata/sf0.001"
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    want, library = expected([text[i] for i in sorted(text)])
    by = dict(zip(sorted(text), want))
    for r in op3_bpe(spark, sf).collect():
        assert r.n_tokens == len(by[r.doc_id])
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, by[r.doc_id])).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(by[r.doc_id], skip_special_tokens=False).encode()).hexdigest()
    for r in op1_packing(spark, sf).collect():
        ids = np.array([*by[r.doc_id], 1][r.start : r.start + r.length], "<u4")
        assert r.ids_crc32 == zlib.crc32(ids.tobytes()) and len(ids) == r.length

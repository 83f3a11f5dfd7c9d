"""Simple-8b words and token files, against the library's own ids."""

import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from guardwork.llm import token_files as tf
from guardwork.llm import word_pieces
from guardwork.llm.queries import LLM_QUERIES
from guardwork.llm.word_pieces import PLAIN_END, WordTokenizer


@pytest.mark.parametrize("most", [1, 2, 9, 1 << 16, 1 << 30, 1 << 60, (1 << 64) - 1])
@pytest.mark.parametrize("n", [0, 1, 2, 59, 60, 61, 1000])
def test_pack_round_trip(most, n):
    rng = np.random.default_rng(n)
    ids = rng.integers(0, most, n, np.uint64, endpoint=True)
    assert tf.unpack(tf.pack(ids), n).tolist() == ids.tolist()


def test_escapes_among_small_ids():
    rng = random.Random(8)
    ids = np.array([rng.choice([0, 1, 5, 70, 1 << 59, 1 << 61, (1 << 64) - 1]) for _ in range(5000)], np.uint64)
    words = tf.pack(ids)
    assert tf.unpack(words, len(ids)).tolist() == ids.tolist()


def test_small_ids_share_words():
    assert len(tf.pack(np.ones(600, np.uint64))) == 10
    assert len(tf.pack(np.full(600, 30_000, np.uint64))) == 150


def test_any_range_of_a_file_is_read_by_its_blocks(monkeypatch):
    monkeypatch.setattr(tf, "BLOCK_IDS", 64)
    ids = np.random.default_rng(9).integers(0, 50_000, 1000, np.uint64)
    file = tf.TokenFile(tf.file_bytes([5, None, 7], np.array([0, 333, 1000]), ids))
    assert file.ids(100, 700).tolist() == ids[100:700].tolist()
    assert [(d, s, i.tolist()) for d, s, i in file.documents()] == [
        (5, 0, []),
        (None, 0, ids[:333].tolist()),
        (7, 333, ids[333:].tolist()),
    ]


def test_words_are_encoded_as_the_library_encodes_texts(word_tokenizer):
    own, library = WordTokenizer(word_tokenizer), Tokenizer.from_file(word_tokenizer)
    rng = random.Random(10)
    spans = [(0x21, 0x7E), (0x41, 0x7A), (0xA1, 0x24F), (0x370, 0x3FF), (0x300, 0x36F), (0x4E00, 0x4E20)]
    for _ in range(3000):
        text = "".join(" \n\t \x1c'"[rng.randrange(6)] if rng.random() < 0.2 else chr(rng.randint(*rng.choice(spans))) for _ in range(15))
        assert own.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)
    for text in ("<|endoftext|>a b<|startoftext|>", "it's I'LL don't_x_ 12a3", "ΣΑΣ straße İ ŉ ª²"):
        assert own.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_every_letter_that_arrays_cut(word_tokenizer):
    own, library = WordTokenizer(word_tokenizer), Tokenizer.from_file(word_tokenizer)
    frames = ("{0}", "a{0}b", "1{0}2", "!{0}!", " {0}'s", "{0}{0}", "x'{0}s", "'{0}e'll")
    texts = [frame.format(chr(c)) for c in range(PLAIN_END) for frame in frames]
    for text, ids in zip(texts, own.encode_texts(texts), strict=True):
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_texts_longer_than_a_stretch_or_a_block(word_tokenizer, monkeypatch):
    texts = ["don't  stop\nat " * 40, "", "a" * 500, "ends here ", "東京 it's <|endoftext|> " * 30]
    whole = [ids.tolist() for ids in WordTokenizer(word_tokenizer).encode_texts(texts)]
    monkeypatch.setattr(word_pieces, "STRETCH", 16)
    monkeypatch.setattr(word_pieces, "BLOCK", 64)
    monkeypatch.setattr(word_pieces, "LOT_WORDS", 3)
    assert [ids.tolist() for ids in WordTokenizer(word_tokenizer).encode_texts(texts)] == whole


def expected(docs, path):
    library, start, out = Tokenizer.from_file(path), 0, []
    for doc in sorted(docs, key=lambda d: (d.doc_id is not None, d.doc_id or 0, d.text is not None, (d.text or "").encode())):
        ids = [*library.encode(doc.text or "", add_special_tokens=False).ids, 2]
        out.append((doc.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def in_order(rows):
    return sorted(map(tuple, rows), key=lambda r: r[1])


def test_awkward_documents(awkward, word_tokenizer, monkeypatch):
    rows = tf.token_file_report(awkward, word_tokenizer, 2).collect()
    assert in_order(rows) == expected(awkward.collect(), word_tokenizer)


def test_query_on_all_documents(spark, small, word_tokenizer):
    rows = LLM_QUERIES["op6_token_files"](spark, small).collect()
    assert in_order(rows) == expected(spark.read.parquet(f"{small}/documents.parquet").collect(), word_tokenizer)


def test_empty_table(documents, word_tokenizer):
    assert tf.token_file_report(documents(), word_tokenizer, 2).collect() == []

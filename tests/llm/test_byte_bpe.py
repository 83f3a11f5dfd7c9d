"""Byte-level BPE against tiktoken, and the decoder against Python's."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import types as T

from guardwork.llm import byte_bpe, words
from guardwork.llm.queries import LLM_QUERIES
from guardwork.llm.worker_memory import at_work


@pytest.fixture(scope="module")
def library(byte_ranks):
    ranks = byte_bpe.read_ranks(byte_ranks)
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


@pytest.fixture(params=["determined", "undetermined"])
def encode(request, byte_ranks, monkeypatch):
    """With as many states as wanted, and with few, so that guesses are followed."""
    if request.param == "undetermined":
        monkeypatch.setattr(byte_bpe, "MOST_STATES", 20)
        monkeypatch.setattr(byte_bpe, "MOST_WORDS", 10)
    encoder = byte_bpe.worker_encoder.__wrapped__(byte_ranks, public_tokenizers.PATTERN)
    return lambda text: np.frombuffer(encoder(text), np.int32).tolist()


def random_text(rng):
    spans = [(0x20, 0x7E), (0x20, 0x7E), (0xA0, 0x24F), (0x4E00, 0x4FFF), (0x1F600, 0x1F64F)]
    chars = [" \n\t'"[rng.randrange(4)] if rng.random() < 0.3 else chr(rng.randint(*rng.choice(spans))) for _ in range(60)]
    return "".join(chars)


def test_encodes_as_the_library(encode, library):
    rng = random.Random(1)
    for text in [random_text(rng) for _ in range(300)] + ["", " ", "  a", "\n \n b", "don't it'll 's"]:
        assert encode(text) == library.encode_ordinary(text), text


def test_transducer_encodes_any_bytes(byte_ranks, library):
    rng = random.Random(2)
    transducer = byte_bpe.Transducer(byte_bpe.read_ranks(byte_ranks))
    tokens = list(transducer.ranks)
    for _ in range(400):
        piece = b"".join(rng.choices(tokens, k=4))
        assert transducer.encode(piece) == library._encode_single_piece(piece)


def words_of_syllables(rng, n):
    parts = "th he an in er on re ed nd ou ea ti es or st en at to nt ha al le is ng ing ion ble sh wh ly and the tion".split()
    return [" " + "".join(rng.choices(parts, k=rng.randint(2, 5))) for _ in range(n)]


def test_states_suffice_for_many_words(byte_ranks, library):
    """States hold guesses alone; with the tokens that each has yet to emit there were many times more."""
    transducer = byte_bpe.Transducer(byte_bpe.read_ranks(byte_ranks))
    for word in words_of_syllables(random.Random(5), 25_000):
        assert transducer.encode(word.encode()) == library._encode_single_piece(word.encode())
    assert transducer.missed == 0


def test_guesses_that_are_a_state_again_go_on_there(byte_ranks, library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "MOST_STATES", 300)
    transducer = byte_bpe.Transducer(byte_bpe.read_ranks(byte_ranks))
    for word in words_of_syllables(random.Random(6), 2_000):
        assert transducer.encode(word.encode()) == library._encode_single_piece(word.encode())
    assert transducer.missed and len(transducer.guesses) == 300


def test_pairs_agree_as_merging_says(byte_ranks, library):
    rng = random.Random(3)
    transducer = byte_bpe.Transducer(byte_bpe.read_ranks(byte_ranks))
    tokens = [t for t in transducer.ranks if transducer.merges.reached(t)]
    for left, right in zip(rng.choices(tokens, k=500), rng.choices(tokens, k=500), strict=True):
        whole = left + right
        alone = [transducer.ranks[left], transducer.ranks[right]]
        expected = whole not in transducer.ranks and library._encode_single_piece(whole) == alone
        assert transducer.merges.stay_apart(left, right) == expected


def test_other_patterns_are_matched_whole(byte_ranks):
    pattern = r"\w+|\W"
    encoder = byte_bpe.worker_encoder.__wrapped__(byte_ranks, pattern)
    ranks = byte_bpe.read_ranks(byte_ranks)
    own = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    assert np.frombuffer(encoder("one two  three"), np.int32).tolist() == own.encode_ordinary("one two  three")
    with pytest.raises(ValueError):
        byte_bpe.worker_encoder.__wrapped__(byte_ranks, r"(\w)+")


def test_machine_reads_malformed_bytes_as_python_does():
    rng = random.Random(4)
    for _ in range(3000):
        data = bytes(rng.choice([rng.randrange(256), 0xE2, 0x82, 0xF0, 0x9F, 0x41]) for _ in range(7))
        state, text = byte_bpe.START, ""
        for byte in data:
            part, state = byte_bpe.read_byte(state, byte)
            text += part
        assert text + "�" * bool(state[0]) == data.decode("utf-8", "replace")


def test_decoding_goes_on_across_feeds(byte_ranks, library):
    decoder = byte_bpe.Decoder(byte_bpe.read_ranks(byte_ranks))
    text = "naïve 東京 😀 und ß" * 3
    ids = library.encode_ordinary(text)
    state, out = byte_bpe.START, ""
    for token in ids:
        part, state = decoder.feed(state, [token])
        out += part
    assert out == text == decoder.decode(ids)


def test_awkward_documents(awkward, byte_ranks, library):
    rows = byte_bpe.round_trip(awkward, byte_ranks, public_tokenizers.PATTERN).collect()
    expected = []
    for doc in awkward.collect():
        ids = library.encode_ordinary(doc.text or "")
        joined = ",".join(map(str, ids)).encode()
        digests = [hashlib.sha256(b).hexdigest() for b in (joined, (doc.text or "").encode())]
        expected.append((doc.doc_id, len(ids), *digests))
    assert sorted(map(tuple, rows), key=str) == sorted(expected, key=str)


def test_other_columns_stay(awkward, byte_ranks):
    coded = byte_bpe.encode(awkward, byte_ranks, public_tokenizers.PATTERN, decode=True)
    assert sorted(coded.columns) == sorted(awkward.columns)
    assert [r.decoded for r in coded.collect()] == [d.text or "" for d in awkward.collect()]


class Here:
    """Runs in this process what Spark would run on its batches."""

    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])

    def mapInArrow(self, run, schema):
        return run


def test_batches_are_encoded_in_small_parts(byte_ranks, library):
    texts = ["two words " * 40_000, None, "", *["naïve 東京 " * 9_000] * 12, "one text of more " * 90_000, "end"]
    batch = pa.record_batch([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], names=["doc_id", "text"])
    run = byte_bpe.encode(Here(), byte_ranks, public_tokenizers.PATTERN, decode=True)
    parts = list(run(iter([batch, batch.slice(0, 0), batch.slice(1, 3)])))
    for part in parts:
        assert part.num_rows == 1 or sum(len((t or "").encode()) for t in part["text"].to_pylist()) <= 1 << 20
    rows = [row for part in parts for row in part.to_pylist()]
    assert [r["doc_id"] for r in rows] == [*range(len(texts)), 1, 2, 3]
    for row in rows:
        assert row["ids"] == library.encode_ordinary(row["text"] or "")
        assert row["decoded"] == (row["text"] or "")


def test_words_are_remembered_once(byte_ranks):
    transducer = byte_bpe.Transducer(byte_bpe.read_ranks(byte_ranks))
    pieces = byte_bpe._Pieces(transducer)
    spaced = byte_bpe._Spaced(lambda text: [text] if text.isalnum() or text[1:].isalnum() else list(text), pieces)
    assert spaced["word"] == pieces.alone(" word")
    assert "word" in spaced and " word" not in pieces


def test_tables_of_words_go_with_their_operator():
    at_work("near_duplicates")
    words.powers(10)
    at_work("byte_bpe")
    assert words._powers.cache_info().currsize == 0


def test_empty_table(documents, byte_ranks):
    assert byte_bpe.round_trip(documents(), byte_ranks, public_tokenizers.PATTERN).collect() == []


def test_query_on_all_documents(spark, small, library):
    got = {r.doc_id: r for r in LLM_QUERIES["op1_byte_bpe"](spark, small).collect()}
    docs = spark.read.parquet(f"{small}/documents.parquet").collect()
    assert len(got) == len(docs)
    for doc in docs:
        ids = library.encode_ordinary(doc.text or "")
        assert got[doc.doc_id].n_tokens == len(ids)
        assert got[doc.doc_id].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[doc.doc_id].decoded_sha256 == hashlib.sha256((doc.text or "").encode()).hexdigest()

"""Alignment of two tokenizers against plain loops over tokens of their own libraries."""

import bisect
import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from guardwork.llm import text_tokens, token_alignment
from guardwork.llm.queries import LLM_QUERIES, alignment_query

BYTES = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(BYTES)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PIECES)


@pytest.fixture(scope="module")
def own():
    return text_tokens.ByteTokens(BYTES, public_tokenizers.PATTERN), text_tokens.PieceTokens(PIECES)


def spelled(library, number):
    piece = library.id_to_piece(number)
    return bytes([int(piece[3:5], 16)]) if library.is_byte(number) else piece.replace("▁", " ").encode()


def byte_spelling(token):
    seen = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in seen]
    letters = {chr(b): b for b in seen} | {chr(256 + i): b for i, b in enumerate(others)}
    return bytes(letters[c] for c in token)


def both(libraries, text):
    a, b = libraries
    if not text:
        return [], []
    found = a.encode(" " + text, add_special_tokens=False)
    left = list(zip(found.ids, map(byte_spelling, found.tokens), strict=True))
    right = [(i, spelled(b, i)) for i in b.encode(text)]
    whole = (" " + text).encode()
    if any(b"".join(s for _, s in side) != whole for side in (left, right)):
        return [], []
    return left, right


def plain_groups(left, right):
    """Ids of both sides by group."""
    ends = []
    for side in (left, right):
        at, found = 0, []
        for _, token in side:
            at += len(token)
            found.append(at)
        ends.append(found)
    shared, out, i, j = sorted(set(ends[0]) & set(ends[1])), [], 0, 0
    for end in shared:
        first, second = i, j
        i, j = bisect.bisect_right(ends[0], end), bisect.bisect_right(ends[1], end)
        out.append(([x for x, _ in left[first:i]], [x for x, _ in right[second:j]]))
    return out


def plain_report(libraries, docs):
    found = [(doc.doc_id, *(sides := both(libraries, doc.text)), plain_groups(*sides)) for doc in docs]
    links = [Counter((a, b) for left, right in groups for a in left for b in right) for *_, groups in found]
    counts = Counter(pair for doc in links for pair in doc)
    highest = Counter()
    for (a, _), n in counts.items():
        highest[a] = max(highest[a], n)
    rows = []
    for (doc_id, left, right, groups), pairs in zip(found, links, strict=True):
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        best = sum(n for (a, b), n in pairs.items() if counts[a, b] == highest[a])
        total = sum(n * counts[pair] for pair, n in pairs.items())
        digest = hashlib.sha256(text.encode()).hexdigest() if text else ""
        rows.append((doc_id, len(left), len(right), len(groups), sum(pairs.values()), best, total, digest))
    return sorted(rows, key=repr)


def got(rows):
    names = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    return sorted((tuple(r[n] for n in names) for r in rows), key=repr)


def test_plain_texts_are_encoded_as_by_the_libraries(own, libraries):
    rng = random.Random(12)
    frames = ("{0}", "a{0}b", "1{0}2", " {0}'s", "{0}{0}", "a {0} {0}b")
    texts = [frame.format(chr(c)) for c in range(text_tokens.PLAIN_END) for frame in frames]
    alphabets = ["abst'rveldm ", "ab'S t\n-_.1²é", "aÀßé漢字σΣ ́'s", "<|endoftext|>  ab", "<s></s> <0x41>▁", " \n\t\r a"]
    texts += ["".join(rng.choices(rng.choice(alphabets), k=rng.randrange(1, 40))) for _ in range(4000)]
    a, b = libraries
    for text in texts:
        assert own[0].encode(" " + text).tolist() == a.encode(" " + text, add_special_tokens=False).ids, repr(text)
        ids = b.encode(text)
        expected = ids if b"".join(spelled(b, i) for i in ids) == (" " + text).encode() else None
        found = own[1].encode(" " + text)
        assert (found if found is None else found.tolist()) == expected, repr(text)


def test_stretches_of_long_texts(own, monkeypatch):
    text = " " + "don't stop  now, déjà vu! " * 50 + "\n\n x"
    whole = [side.encode(text).tolist() for side in own]
    monkeypatch.setattr(text_tokens, "STRETCH", 40)
    assert [side.encode(text).tolist() for side in own] == whole


def test_overlaps_are_all_pairs_that_share_a_byte():
    rng = random.Random(3)
    sides = []
    for _ in range(2):
        ids = []
        for doc in range(5):
            size, lengths = 30 * doc, []
            while sum(lengths) < size:
                lengths.append(min(rng.randint(1, 5), size - sum(lengths)))
            ids.append(np.array(lengths, np.int64))
        sides.append(token_alignment.block_tokens(ids, np.arange(6)))
    a, b = sides
    pairs = list(zip(*map(np.ndarray.tolist, token_alignment.overlaps(a, b)), strict=True))
    expected = [
        (i, j) for i in range(len(a.ids)) for j in range(len(b.ids)) if a.starts[i] < b.ends[j] and b.starts[j] < a.ends[i]
    ]
    assert sorted(pairs) == expected


def test_query_on_all_documents(spark, small, libraries):
    docs = spark.read.parquet(f"{small}/documents.parquet").collect()
    assert got(LLM_QUERIES["op12_token_alignment"](spark, small).collect()) == plain_report(libraries, docs)


def test_awkward_documents_in_small_chunks(awkward, libraries, tmp_path, monkeypatch):
    monkeypatch.setattr(token_alignment, "CHUNK_BYTES", 700)
    monkeypatch.setattr(token_alignment, "BLOCK_BYTES", 300)
    awkward.write.parquet(f"{tmp_path}/documents.parquet")
    rows = alignment_query(awkward.sparkSession, str(tmp_path)).collect()
    assert got(rows) == plain_report(libraries, awkward.collect())


def test_large_groups_and_slices(monkeypatch):
    rng = np.random.default_rng(7)
    ids = [[rng.integers(1, 6, 40) for _ in range(4)] for _ in range(2)]
    size = min(int(x.sum()) for side in ids for x in side)
    cut = [[x[np.cumsum(x) <= size - 5] for x in side] for side in ids]
    cut = [[np.append(x, size - x.sum()) for x in side] for side in cut]
    a, b = (token_alignment.block_tokens(side, np.arange(size + 1)) for side in cut)
    found = token_alignment.groups(a, b)
    expected = token_alignment.links(a, b, found)
    for large, held in ((0, 1 << 20), (3, 5), (1 << 30, 7)):
        monkeypatch.setattr(token_alignment, "LARGE_GROUP", large)
        monkeypatch.setattr(token_alignment, "SLICE_LINKS", held)
        for x, y in zip(token_alignment.links(a, b, found), expected, strict=True):
            assert x.tolist() == y.tolist()


def test_tokens_and_groups_of_each_document(awkward, libraries):
    rows = token_alignment.align(awkward, BYTES, public_tokenizers.PATTERN, PIECES).collect()
    found = []
    for r in rows:
        n = max(r.a_group, default=-1) + 1
        sides = [[[i for i, g in zip(ids, of, strict=True) if g == k] for k in range(n)] for ids, of in ((r.a_ids, r.a_group), (r.b_ids, r.b_group))]
        found.append((r.doc_id, list(zip(*sides, strict=True))))
    expected = [(d.doc_id, plain_groups(*both(libraries, d.text))) for d in awkward.collect()]
    assert sorted(found, key=repr) == sorted(expected, key=repr)


def test_empty_table(documents):
    assert token_alignment.alignment_report(documents(), BYTES, public_tokenizers.PATTERN, PIECES).collect() == []

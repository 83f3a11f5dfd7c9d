"""Best-fit packing: the packer against a plain one, sequences without gaps, ids of the library."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from guardwork.llm import packing
from guardwork.llm.queries import LLM_QUERIES


class PlainPacker:
    """Open bins in a list."""

    def __init__(self, size, most):
        self.size, self.most, self.open, self.bins = size, most, [], []

    def put(self, length):
        fits = [b for b in self.open if self.size - sum(b) >= length]
        if fits:
            target = max(fits, key=sum)
        else:
            if len(self.open) == self.most:
                self.open.remove(max(self.open, key=sum))
            target = []
            self.open.append(target)
            self.bins.append(target)
        target.append(length)
        if sum(target) == self.size:
            self.open = [b for b in self.open if b is not target]


@pytest.mark.parametrize("most", [1, 3, 40])
def test_packer_places_as_a_plain_one(most):
    rng = random.Random(most)
    for _ in range(40):
        size = rng.choice([8, 100])
        lengths = [rng.randint(1, size) for _ in range(200)]
        packer, plain = packing.BestFit(size, most), PlainPacker(size, most)
        bins = []
        for length in lengths:
            bins += packer.put(length, length)
            assert packer.n_open <= most
            plain.put(length)
        bins += packer.still_open()
        # Bins of equal free space are alike, so the sums agree though the pieces may differ.
        assert sorted(sum(p for p, _ in b.pieces) for b in bins) == sorted(map(sum, plain.bins))
        for b in bins:
            at = 0
            for piece, offset in b.pieces:
                assert offset == at
                at += piece
            assert at == size - b.free


def check(rows, docs, path, size, end_id):
    library, expected = Tokenizer.from_file(path), []
    for doc in docs:
        ids = [*library.encode(doc.text or "", add_special_tokens=False).ids, end_id]
        for number, start in enumerate(range(0, len(ids), size)):
            part = np.array(ids[start : start + size], "<u4")
            expected.append((doc.doc_id, number, start, len(part), zlib.crc32(part.tobytes())))
    got = [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
    return len(sequences), -(-sum(r.length for r in rows) // size)


def test_query_on_all_documents(spark, medium, word_tokenizer):
    rows = LLM_QUERIES["op11_packing"](spark, medium).collect()
    used, least = check(rows, spark.read.parquet(f"{medium}/documents.parquet").collect(), word_tokenizer, 2048, 0)
    assert used <= 1.02 * least + 1


@pytest.mark.parametrize("size", [1, 5, 64])
def test_awkward_documents(awkward, word_tokenizer, size):
    rows = packing.pack(awkward, word_tokenizer, 0, size, keep_ids=True).collect()
    check(rows, awkward.collect(), word_tokenizer, size, 0)
    assert all(len(r.ids) == 4 * r.length and zlib.crc32(r.ids) == r.ids_crc32 for r in rows)


def test_many_small_partitions_are_packed_together(documents, word_tokenizer):
    docs = documents(["a few words only"] * 640).repartition(160)
    rows = packing.pack(docs, word_tokenizer, 0, 100).collect()
    used, least = check(rows, docs.collect(), word_tokenizer, 100, 0)
    assert used <= least + 3


def test_same_rows_when_run_again(awkward, word_tokenizer):
    runs = [sorted(map(tuple, packing.pack(awkward.coalesce(2), word_tokenizer, 0, 64).collect()), key=repr) for _ in range(2)]
    assert runs[0] == runs[1]


def test_empty_table(documents, word_tokenizer):
    assert packing.pack(documents(), word_tokenizer, 0, 64).collect() == []

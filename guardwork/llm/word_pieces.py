"""Ids of texts by the word tokenizer (lower case, white space dropped, marked word ends).

A text is first written as its pieces, each followed by one space, as the tokenizer's own
normalizer and pre-tokenizer would cut it.  The space stands for the mark of a word's end: it
joins the last byte of its piece before any other merge.  So the vocabulary becomes one of plain
bytes, and tiktoken merges it at the speed of its native code, without a memory of words that
would fill up.  Two neighbours merge by the rank of their concatenation there, by the rank of the
pair here; the two agree, since no merge that crosses a token's ends can have come before it, and
so its bytes were merged as if alone.

Letters up to U+024F are cut by whole arrays of code points; words with any other letter are cut
by the library itself.  The tokenizer never looks across white space, so the distinct words of a
block of texts are encoded once, and the ids of the texts are gathered from theirs.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterable, Iterator
from itertools import count

import numpy as np
import tiktoken

from guardwork.llm.worker_memory import remembered

#: Texts are read in stretches of so many characters, cut at spaces, and distinct words are
#: looked for in blocks of so many.
STRETCH = 1 << 18
BLOCK = 1 << 22
LOT_WORDS = 1 << 14
PLAIN_END = 0x250
_SPACE, _LETTER, _NUMBER, _OTHER = range(4)
_SPACES = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0]
_QUOTE = ord("'")
_END_OF_WORD = "</w>"
#: Not in any piece of a text, as white space is dropped; behind a word's ids in place of an id.
_MARK = "\n"
MARKED = (1 << 32) - 1


def byte_letters() -> dict[int, str]:
    """By byte, the character that stands for it in the vocabulary: itself if it can be seen, or
    else the next one from 256 on."""
    seen = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in seen]
    return {b: chr(b) for b in seen} | {b: chr(256 + i) for i, b in enumerate(others)}


def _kinds() -> np.ndarray:
    kinds = {"L": _LETTER, "N": _NUMBER}
    found = [kinds.get(unicodedata.category(chr(c))[0], _OTHER) for c in range(PLAIN_END)]
    for c in _SPACES:
        found[c] = _SPACE
    return np.array(found, np.uint8)


def stretches(text: str) -> Iterator[str]:
    """The text in parts that end at a space or a line's end."""
    start = 0
    while len(text) - start > STRETCH:
        found = _GAP.search(text, start + STRETCH)
        if not found:
            break
        yield text[start : found.end()]
        start = found.end()
    yield text[start:]


_GAP = re.compile("[ \n]")


class WordTokenizer:
    """Ids of a text, equal to those of the tokenizers library without added special tokens."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.bytes_of = {letter: byte for byte, letter in byte_letters().items()}
        model = json.loads(self.library.to_str())["model"]
        special = {t.content: i for i, t in self.library.get_added_tokens_decoder().items()}
        lowered = [self.library.normalizer.normalize_str(f"x{chr(c)}x")[1:-1] for c in range(PLAIN_END)]
        self.lower = np.array([ord(s) if len(s) == 1 else c for c, s in enumerate(lowered)], np.uint32)
        self.kinds = _kinds()
        folds = "".join(chr(c) for c, s in enumerate(lowered) if len(s) != 1)
        self.odd = re.compile("|".join([f"[{folds}{chr(PLAIN_END)}-{chr(0x10FFFF)}]", *map(re.escape, special)]))
        self.special = {content: f"\n{i} " for content, i in special.items()}
        self.specials = re.compile(f"({'|'.join(map(re.escape, special))})" if special else "(?!)")
        self.encoder, self.ids = self._encoder(model, special)

    def _encoder(self, model: dict, special: dict[str, int]) -> tuple[tiktoken.Encoding, np.ndarray]:
        """The vocabulary over bytes, by rank, and the id of each rank."""
        letters, vocabulary = byte_letters(), model["vocab"]
        ranks: dict[bytes, int] = {}
        ids: list[int] = []

        def add(token: bytes, number: int) -> None:
            ranks[token] = len(ids)
            ids.append(number)

        for byte in range(256):
            add(bytes([byte]), vocabulary[letters[byte]])
        for byte in range(256):
            add(bytes([byte]) + b" ", vocabulary[letters[byte] + _END_OF_WORD])
        for pair in model["merges"]:
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            add(self._bytes(left + right), vocabulary[left + right])
        for number in special.values():
            add(f"\n{number} ".encode(), number)
        add(f"{_MARK} ".encode(), MARKED)
        encoder = tiktoken.Encoding("words", pat_str="[^ ]+ ", mergeable_ranks=ranks, special_tokens={})
        return encoder, np.array(ids, np.uint32)

    def _bytes(self, token: str) -> bytes:
        ended = token.endswith(_END_OF_WORD)
        token = token[: -len(_END_OF_WORD)] if ended else token
        return bytes(map(self.bytes_of.__getitem__, token)) + (b" " if ended else b"")

    def _plain(self, words: list[str]) -> str:
        """The pieces of words whose letters are all below PLAIN_END, with a mark behind each word."""
        codes = np.frombuffer((" ".join(words) + " ").encode("utf-32-le"), np.uint32)
        kind, low = self.kinds[codes], self.lower[codes]
        gap = codes == ord(" ")
        last = kind == _NUMBER
        last[:-1] |= kind[:-1] != kind[1:]
        last &= kind != _SPACE
        quotes = np.flatnonzero(low == _QUOTE)
        if len(quotes):
            # A quote at the start of its piece takes the letters of 's, 't, 'm, 'd, 're, 've, 'll along.
            quotes = quotes[(quotes == 0) | (kind[quotes - 1] != _OTHER)]
            behind = np.concatenate((low, np.zeros(2, np.uint32)))
            first, second = behind[quotes + 1], behind[quotes + 2]
            short = np.isin(first, [ord(c) for c in "stmd"])
            long = ~short & np.logical_or.reduce([(first == ord(a)) & (second == ord(b)) for a, b in ("re", "ve", "ll")])
            last[quotes[short | long]] = False
            last[quotes[short] + 1] = True
            last[quotes[long] + 2] = True
        low[gap] = ord(_MARK)
        kept, last = (kind != _SPACE) | gap, last | gap
        size = kept.astype(np.int64) + last
        ends = np.cumsum(size)
        out = np.full(ends[-1], ord(" "), np.uint32)
        out[(ends - size)[kept]] = low[kept]
        return out.tobytes().decode("utf-32-le")

    def _odd(self, word: str) -> str:
        """The pieces of a word by the library's own rules, and a mark; special tokens are pieces."""
        out = []
        for part in self.specials.split(word):
            if part in self.special:
                out.append(self.special[part])
            elif part:
                cut = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(part))
                out += [bytes(map(self.bytes_of.__getitem__, piece)).decode() + " " for piece, _ in cut]
        return "".join([*out, f"{_MARK} "])

    def pieces(self, words: list[str]) -> str:
        """The words' pieces, each followed by a space; a mark is the last piece of each word."""
        if not self.odd.search(" ".join(words)):
            return self._plain(words)
        out, plain = [], []
        for word in words:
            if self.odd.search(word):
                if plain:
                    out.append(self._plain(plain))
                out.append(self._odd(word))
                plain = []
            else:
                plain.append(word)
        return "".join([*out, self._plain(plain)] if plain else out)

    def word_ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, a mark behind those of each, and where the marks are."""
        lots = [self.encoder.encode_ordinary(self.pieces(words[i : i + LOT_WORDS])) for i in range(0, len(words), LOT_WORDS)]
        ids = self.ids[np.concatenate([np.fromiter(lot, np.int64, len(lot)) for lot in lots])]
        return ids, np.flatnonzero(ids == MARKED)

    def _block(self, parts: list[str]) -> list[np.ndarray]:
        numbers = defaultdict(count().__next__)  # words in the order of their first use
        places = []
        for part in parts:
            words = part.replace("\n", " ").split(" ")
            places.append(np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)))
        ids, marks = self.word_ids(list(numbers))
        starts = np.concatenate(([0], marks[:-1] + 1))
        sizes = marks - starts
        out = []
        for place in places:
            size = sizes[place]
            ends = np.cumsum(size)
            at = np.repeat(starts[place] - (ends - size), size)
            out.append(ids[at + np.arange(len(at))])
        return out

    def encode_texts(self, texts: Iterable[str]) -> Iterator[np.ndarray]:
        """Ids of each text, worked out a block of texts at a time."""
        held: list[str] = []
        cut: list[int] = []  # parts of each text that is held
        size = 0
        for text in texts:
            before = len(held)
            for part in stretches(text):
                held.append(part)
                size += len(part)
            cut.append(len(held) - before)
            if size >= BLOCK:
                yield from self._whole(held, cut)
                held, cut, size = [], [], 0
        if cut:
            yield from self._whole(held, cut)

    def _whole(self, parts: list[str], cut: list[int]) -> Iterator[np.ndarray]:
        found: list[np.ndarray] = []
        at = 0
        for first, last in _blocks([len(p) for p in parts]):
            found += self._block(parts[first:last])
        for n in cut:
            yield found[at] if n == 1 else np.concatenate(found[at : at + n])
            at += n

    def encode(self, text: str) -> np.ndarray:
        return next(self.encode_texts([text]))


def _blocks(sizes: list[int]) -> Iterator[tuple[int, int]]:
    first, size = 0, 0
    for i, n in enumerate(sizes):
        size += n
        if size >= BLOCK or i + 1 == len(sizes):
            yield first, i + 1
            first, size = i + 1, 0


@remembered("word_pieces")
def worker_tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)

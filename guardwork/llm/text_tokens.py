"""Ids and byte lengths of tokens by two public tokenizers: byte-level BPE and pieces with byte fallback.

Both give the ids of their own libraries.  Texts whose letters are all below `PLAIN_END` are
merged by tiktoken's native code over the same vocabulary: there, as in both libraries, the best
ranked pair of neighbours is merged first, the leftmost of equal ones, and each piece between
borders that no merge crosses is merged by itself.  All other texts, and any vocabulary for which
that does not hold, go through the library.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import tiktoken

from guardwork.llm.word_pieces import byte_letters
from guardwork.llm.worker_memory import remembered

PLAIN_END = 0x250
#: Long texts are encoded in stretches, cut in front of a single space between visible letters,
#: where neither tokenizer merges.
STRETCH = 1 << 18
_BORDER = re.compile("(?<=[!-~])(?= [!-~])")
_PLAIN = re.compile(f"[^\0-{chr(PLAIN_END - 1)}]")


def stretches(text: str) -> Iterator[str]:
    start = 0
    while len(text) - start > STRETCH:
        found = _BORDER.search(text, start + STRETCH)
        if not found:
            break
        yield text[start : found.start()]
        start = found.start()
    yield text[start:]


class _Tokens:
    """spelling: bytes by id; plain: the encoder of plain texts and the ids of its ranks, if there is one."""

    spelling: list[bytes]
    odd: re.Pattern = _PLAIN
    plain: tiktoken.Encoding | None = None
    plain_ids: np.ndarray

    def library_ids(self, text: str) -> list[int]:
        raise NotImplementedError

    def _ids(self, text: str) -> np.ndarray:
        if self.plain is None or self.odd.search(text):
            return np.array(self.library_ids(text), np.int64)
        found = self.plain.encode_ordinary(text)
        return self.plain_ids[np.fromiter(found, np.int64, len(found))]

    def encode(self, text: str) -> np.ndarray | None:
        """Ids of a text that starts with a space; None if their bytes are not the text's."""
        parts = [self._ids(part) for part in stretches(text)]
        ids = parts[0] if len(parts) == 1 else np.concatenate(parts)
        if self.plain is None or self.odd.search(text):
            spelled = b"".join(map(self.spelling.__getitem__, ids.tolist()))
            if spelled != text.encode():
                return None
        return ids

    def lengths(self) -> np.ndarray:
        return np.array([len(s) for s in self.spelling], np.int64)


class ByteTokens(_Tokens):
    """A byte-level BPE file of the tokenizers library; pattern cuts the text as its pre-tokenizer does."""

    def __init__(self, path: str, pattern: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        model = json.loads(self.library.to_str())["model"]
        byte_of = {letter: byte for byte, letter in byte_letters().items()}
        self.spelling = [b""] * self.library.get_vocab_size()
        for token, number in model["vocab"].items():
            self.spelling[number] = bytes(map(byte_of.__getitem__, token))
        numbers = [model["vocab"][letter] for letter in byte_letters().values()]
        for pair in model["merges"]:
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            numbers.append(model["vocab"][left + right])
        ranks = {self.spelling[number]: rank for rank, number in enumerate(numbers)}
        self.plain = tiktoken.Encoding("bytes", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.plain_ids = np.array(numbers, np.int64)

    def library_ids(self, text: str) -> list[int]:
        return self.library.encode(text, add_special_tokens=False).ids


class PieceTokens(_Tokens):
    """A piece model; the library puts the first space in front itself."""

    _PROBES = ("a  b", " a", "a ", "   ", "a\tb\n\nc", "x" * 40, "Straße, déjà vu!  12,345.00 == 0x1F", "ab\r\n\x0b\x0c cd")

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.library.id_to_piece(i) for i in range(self.library.get_piece_size())]
        is_byte, unspoken = self.library.is_byte, lambda i: self.library.is_control(i) or self.library.is_unknown(i)
        self.spelling = [
            bytes([int(p[3:5], 16)]) if is_byte(i) else b"" if unspoken(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(pieces)
        ]
        self._merge_plain_texts(pieces)

    def _merge_plain_texts(self, pieces: list[str]) -> None:
        library = self.library
        texts = {
            i: piece.replace("▁", " ")
            for i, piece in enumerate(pieces)
            if not (library.is_byte(i) or library.is_control(i) or library.is_unknown(i) or library.is_unused(i))
        }
        if any(re.search("[^ ] ", text) for text in texts.values()):
            return  # merges may cross the border in front of a space
        fallback = {self.spelling[i]: i for i in range(len(pieces)) if library.is_byte(i)}
        if len(fallback) < 256:
            return
        plain = {text: i for i, text in texts.items() if not _PLAIN.search(text)}
        # Letters first: bytes, then the letters of two bytes, then longer pieces by their score.
        order = [plain.get(chr(b), fallback[bytes([b])]) if b < 128 else fallback[bytes([b])] for b in range(256)]
        tokens = [bytes([b]) for b in range(256)]
        longer = sorted(plain.items(), key=lambda item: (len(item[0]) > 1, -library.get_score(item[1]), item[1]))
        for text, number in longer:
            if len(text.encode()) > 1:
                tokens.append(text.encode())
                order.append(number)
        ranks = {token: rank for rank, token in enumerate(tokens)}
        self.plain = tiktoken.Encoding("pieces", pat_str=" +[^ ]*|[^ ]+", mergeable_ranks=ranks, special_tokens={})
        self.plain_ids = np.array(order, np.int64)
        odd = [c for c in map(chr, range(PLAIN_END)) if not self._agrees(f"a{c}b") or not self._agrees(c)]
        self.odd = re.compile(f"[^\0-{chr(PLAIN_END - 1)}]" + "".join(f"|{re.escape(c)}" for c in odd))
        if not all(map(self._agrees, self._PROBES)):
            self.plain = None

    def _agrees(self, text: str) -> bool:
        found = self.plain_ids[self.plain.encode_ordinary(" " + text)].tolist()
        return found == self.library.encode(text, num_threads=1)

    def library_ids(self, text: str) -> list[int]:
        return self.library.encode(text[1:], num_threads=1)


@remembered("text_tokens")
def worker_byte_tokens(path: str, pattern: str) -> ByteTokens:
    return ByteTokens(path, pattern)


@remembered("text_tokens")
def worker_piece_tokens(path: str) -> PieceTokens:
    return PieceTokens(path)

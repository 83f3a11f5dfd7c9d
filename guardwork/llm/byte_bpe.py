"""Byte-level BPE, encoded by a transducer and decoded by a UTF-8 state machine.

Encoding.  A sequence of tokens is the encoding of its bytes exactly if every two
neighbours are the encoding of their concatenation.  So a nondeterministic transducer can
read bytes while it spells a token along the vocabulary's trie, guess where that token
ends, and go on if its neighbour agrees; one guess alone survives to the end.  The
transducer is made deterministic as texts need it: a state is the set of guesses still
possible.  At any place one of them at most ends a token, which goes with the state, so the
tokens are read back from the end of the piece, each from where the one after it starts.
States and steps are remembered per Python worker.

Decoding.  Tokens end anywhere within a character, so the decoder is an incremental UTF-8
state machine over bytes.  The effect of a whole token on a state is remembered.  Malformed
bytes become U+FFFD, one for each longest part of a character.

Defined results: a null text is empty and has no ids; ids and bytes depend on the text
alone, so repeated rows agree; very long texts are matched piece by piece; an empty table
gives an empty result; other columns are kept by `encode` (but for the two it writes) and
`encode_documents`.
"""

from __future__ import annotations

import base64
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from guardwork.llm.worker_memory import remembered
from guardwork.llm.words import text_bytes

#: States, pieces of texts, and words with a space in front that a worker remembers.  Beyond that,
#: pieces are worked out each time, by the guesses themselves where a state is missing, with the
#: same results.  Once that happened `MOST_MISSED` times, all states give way: those that are
#: still used come back first.
MOST_STATES = 200_000
MOST_MISSED = 200_000
MOST_PIECES = 100_000
MOST_AGREED = 200_000
MOST_WORDS = 300_000
LONGEST_REMEMBERED = 48
#: Bytes of texts that are encoded together; a batch from Spark holds many times more.
PART_BYTES = 1 << 20

LAST = 1 << 62  # after every rank
UNDETERMINED = -1
_NODE_BITS = 32
_NODE = (1 << _NODE_BITS) - 1


def read_ranks(path: str) -> dict[bytes, int]:
    """Bytes and rank of each token from a file of base64 bytes and rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Merges:
    """Which tokens, and which pairs of tokens, are the encoding of their own bytes."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.halves: dict[bytes, tuple[bytes, bytes] | None] = {}
        self.rights: dict[bytes, list[tuple[bytes, int]]] = {}
        self.lefts: dict[bytes, list[tuple[bytes, int]]] = {}

    def split(self, token: bytes) -> tuple[bytes, bytes] | None:
        """The two tokens that the token is merged from; None if merging does not lead to it."""
        if token not in self.halves:
            parts = [token[i : i + 1] for i in range(len(token))]
            while len(parts) > 2:
                pairs = [self.ranks.get(x + y, LAST) for x, y in zip(parts, parts[1:], strict=False)]
                at = pairs.index(min(pairs))
                if pairs[at] == LAST:
                    break
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
            self.halves[token] = (parts[0], parts[1]) if len(parts) == 2 else None
        return self.halves[token]

    def reached(self, token: bytes) -> bool:
        return len(token) == 1 or self.split(token) is not None

    def edge(self, token: bytes, side: int) -> list[tuple[bytes, int]]:
        """The parts that stand at the token's left (0) or right (1) edge while it is merged,
        with the rank of the merge that ends each."""
        memo = self.rights if side else self.lefts
        if token not in memo:
            parts, ends, part = [], LAST, token
            while True:
                parts.append((part, ends))
                if len(part) == 1:
                    break
                ends, part = self.ranks[part], self.split(part)[side]
            memo[token] = parts
        return memo[token]

    def stay_apart(self, left: bytes, right: bytes) -> bool:
        """No merge across the border comes before those that build the two tokens.

        Merges come in order of rank; of equal ones the leftmost comes first.
        """
        for x, x_ends in self.edge(left, 1):
            for y, y_ends in self.edge(right, 0):
                rank = self.ranks.get(x + y)
                if rank is not None and rank < x_ends and rank <= y_ends:
                    return False
        return True


class Transducer:
    """Encodes pieces of bytes; deterministic states are made when first reached."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.spelling = {rank: token for token, rank in ranks.items()}
        self.child: dict[int, int] = {}  # by node * 256 + byte
        self.token: list[int] = [-1]  # of each trie node
        for token, rank in ranks.items():
            node = 0
            for byte in token:
                further = self.child.get(node << 8 | byte)
                if further is None:
                    further = self.child[node << 8 | byte] = len(self.token)
                    self.token.append(-1)
                node = further
            self.token[node] = rank
        self.sizes = {rank: len(token) for token, rank in ranks.items()}
        self.merges = Merges(ranks)
        self.agreed: dict[int, bool] = {}  # by last * 2^24 + token
        self.forget()

    def forget(self) -> None:
        """Back to the first state."""
        self.missed = 0
        # A guess is the last token + 1 (0: none), and the trie node of the token being spelled.
        self.ids: dict[bytes, int] = {}
        self.guesses: list[bytes] = []  # of each state, those that began first in front
        self.steps: dict[int, int] = {}  # by state * 256 + byte
        self.ended: list[int] = []  # the token that ends in each state
        self.state(array("q", [0]))

    def state(self, guesses: array) -> int:
        """The state of these guesses; UNDETERMINED if no further state may be made."""
        key = guesses.tobytes()
        known = self.ids.get(key)
        if known is None:
            if len(self.guesses) >= MOST_STATES:
                return UNDETERMINED
            known = self.ids[key] = len(self.guesses)
            self.guesses.append(key)
            self.ended.append(self.end(guesses))
        return known

    def agrees(self, last: int, token: int) -> bool:
        """Is (last, token) the encoding of its bytes?  For -1: is token that of its own?"""
        known = self.agreed.get(last << 24 | token)
        if known is None:
            right = self.spelling[token]
            known = self.merges.reached(right) and (
                last < 0 or self.merges.stay_apart(self.spelling[last], right)
            )
            if len(self.agreed) < MOST_AGREED:
                self.agreed[last << 24 | token] = known
        return known

    def end(self, guesses: array) -> int:
        """The token of the one guess that holds if the piece ends here; -1 if none does."""
        found, token_at, agreed = -1, self.token, self.agreed.get
        for guess in guesses:
            token = token_at[guess & _NODE]
            if token >= 0:
                last = (guess >> _NODE_BITS) - 1
                known = agreed(last << 24 | token)
                if known or known is None and self.agrees(last, token):
                    if found >= 0:
                        raise ValueError("the vocabulary's ranks do not make a byte-level BPE")
                    found = token
        return found

    def after(self, guesses: array, ended: int, byte: int) -> array:
        """The guesses that survive the byte, and the one of a token that starts with it."""
        child = self.child.get
        found = array("q")
        for guess in guesses:
            node = guess & _NODE
            further = child(node << 8 | byte)
            if further is not None:
                found.append(guess - node + further)
        if ended >= 0:
            first = child(byte)
            if first is not None:
                found.append(ended + 1 << _NODE_BITS | first)
        if not found:
            raise ValueError(f"the vocabulary has no token for byte {byte}")
        return found

    def step(self, state: int, byte: int) -> int:
        """The next state; UNDETERMINED if no further state may be made."""
        guesses = array("q", self.guesses[state])
        result = self.steps[state << 8 | byte] = self.state(self.after(guesses, self.ended[state], byte))
        return result

    def encode(self, piece: bytes) -> list[int]:
        if not piece:
            return []
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        if self.missed >= MOST_MISSED:
            self.forget()
        state, steps, ended = 0, self.steps, self.ended
        ends: list[int] = []  # the token that ends with each byte
        for byte in piece:
            following = steps.get(state << 8 | byte)
            if following is None:
                following = self.step(state, byte)
            if following < 0:
                self.missed += 1
                ends += self.undetermined(state, piece[len(ends) :])
                break
            state = following
            ends.append(ended[state])
        out: list[int] = []
        at, sizes = len(piece), self.sizes
        while at:
            token = ends[at - 1]
            if token < 0:
                raise ValueError("the vocabulary's ranks do not make a byte-level BPE")
            out.append(token)
            at -= sizes[token]
        out.reverse()
        return out

    def undetermined(self, state: int, rest: bytes) -> list[int]:
        """The tokens that end with each further byte, by the guesses themselves until they are a state again."""
        guesses, ended = array("q", self.guesses[state]), self.ended[state]
        state, steps, ends = UNDETERMINED, self.steps, []
        for byte in rest:
            following = UNDETERMINED
            if state >= 0:
                following = steps.get(state << 8 | byte)
                if following is None:
                    following = self.step(state, byte)
                if following < 0:
                    guesses = array("q", self.guesses[state])
            if following < 0:
                guesses = self.after(guesses, ended, byte)
                following = self.ids.get(guesses.tobytes(), UNDETERMINED)
            state = following
            ended = self.end(guesses) if state < 0 else self.ended[state]
            ends.append(ended)
        return ends


class _Pieces(dict):
    """Ids by piece of text, as an array's bytes, filled on demand."""

    def __init__(self, transducer: Transducer):
        super().__init__()
        self.transducer = transducer

    def alone(self, piece: str) -> bytes:
        """The ids, not remembered here."""
        return array("i", self.transducer.encode(piece.encode())).tobytes()

    def __missing__(self, piece: str) -> bytes:
        ids = self.alone(piece)
        if len(piece) <= LONGEST_REMEMBERED and len(self) < MOST_PIECES:
            self[piece] = ids
        return ids


class _Spaced(dict):
    """Ids by word, of the word with one space in front; a word of one piece is not remembered as
    that piece besides."""

    def __init__(self, split, pieces: _Pieces):
        super().__init__()
        self.split = split
        self.pieces = pieces

    def __missing__(self, word: str) -> bytes:
        found = self.split(" " + word)
        if len(word) > LONGEST_REMEMBERED or len(self) >= MOST_WORDS:
            return b"".join(map(self.pieces.__getitem__, found))
        if len(found) == 1:
            ids = self.pieces.get(found[0]) or self.pieces.alone(found[0])
        else:
            ids = b"".join(map(self.pieces.__getitem__, found))
        self[word] = ids
        return ids


#: Of a leading byte: continuation bytes to come, and the bounds of the first of them.
def _lead(byte: int) -> tuple[int, int, int] | None:
    if 0xC2 <= byte <= 0xDF:
        return 1, 0x80, 0xBF
    if 0xE0 <= byte <= 0xEF:
        return 2, {0xE0: 0xA0}.get(byte, 0x80), {0xED: 0x9F}.get(byte, 0xBF)
    if 0xF0 <= byte <= 0xF4:
        return 3, {0xF0: 0x90}.get(byte, 0x80), {0xF4: 0x8F}.get(byte, 0xBF)
    return None


START = (0, 0, 0, 0)  # continuation bytes to come, bounds of the next, code so far


def read_byte(state: tuple[int, int, int, int], byte: int) -> tuple[str, tuple[int, int, int, int]]:
    """Text completed by the byte, and the next state."""
    need, low, high, code = state
    if need:
        if not low <= byte <= high:
            text, state = read_byte(START, byte)
            return "�" + text, state
        code = code << 6 | byte & 0x3F
        return (chr(code), START) if need == 1 else ("", (need - 1, 0x80, 0xBF, code))
    if byte < 0x80:
        return chr(byte), START
    lead = _lead(byte)
    if lead is None:
        return "�", START
    return "", (*lead, byte & (0x3F >> lead[0]))


class Decoder:
    """Text of token ids; what a token does to a state is remembered."""

    def __init__(self, ranks: dict[bytes, int]):
        self.spelling = {rank: token for token, rank in ranks.items()}
        self.known: dict[tuple, dict[int, tuple[str, tuple]]] = {}
        self.whole: dict[int, str] = {}
        for rank in self.spelling:
            text, state = self.step(START, rank)
            if state is START:
                self.whole[rank] = text

    def step(self, state: tuple, token: int) -> tuple[str, tuple]:
        at, text = state, []
        for byte in self.spelling[token]:
            part, at = read_byte(at, byte)
            text.append(part)
        result = "".join(text), at
        self.known.setdefault(state, {})[token] = result
        return result

    def feed(self, state: tuple, ids: list[int]) -> tuple[str, tuple]:
        """Text completed by the ids, and the state to go on from."""
        # Between characters most tokens are whole characters; only the others need the machine.
        texts = list(map(self.whole.get, ids)) if state is START else [None] * len(ids)
        if state is not START or None in texts:
            for i, token in enumerate(ids):
                if texts[i] is None or state is not START:
                    texts[i], state = self.known.setdefault(state, {}).get(token) or self.step(state, token)
        return "".join(texts), state

    def decode(self, ids) -> str:
        text, state = self.feed(START, ids)
        return text + "�" if state[0] else text


#: Patterns that never match across the border in front of a space that a word follows, so that
#: such words can be looked up whole.  Fixed value: the split that goes with the rank files.
SPLITS_AT_SPACES = (
    r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""",
)
_SPACE_BEFORE_SPACE = re.compile(r" (?:\s|$)")


@remembered("byte_bpe")
def worker_encoder(path: str, pattern: str):
    """Of this Python worker: text to an array of ids, as bytes."""
    compiled = regex.compile(pattern)
    if compiled.groups:
        raise ValueError("the pattern must not have groups of its own")
    pieces = _Pieces(Transducer(read_ranks(path)))

    def encode(text: str) -> bytes:
        return b"".join(map(pieces.__getitem__, compiled.findall(text)))

    if pattern not in SPLITS_AT_SPACES:
        return encode
    spaced = _Spaced(compiled.findall, pieces)

    def encode_words(text: str) -> bytes:
        if _SPACE_BEFORE_SPACE.search(text):
            return encode(text)
        first, *words = text.split(" ")
        return encode(first) + b"".join(map(spaced.__getitem__, words))

    return encode_words


@remembered("byte_bpe")
def worker_decoder(path: str) -> Decoder:
    return Decoder(read_ranks(path))


def id_lists(encoded: list[bytes]) -> pa.ListArray:
    sizes = np.fromiter(map(len, encoded), np.int64, len(encoded)) // 4
    offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    values = np.frombuffer(b"".join(encoded), np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of `PART_BYTES` of texts at most, or of one text: ids and texts are many times larger
    as Python's objects."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(batch.schema.get_field_index("text"))).fill_null(0)
        ends = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64))
        first = 0
        while first < batch.num_rows:
            before = ends[first - 1] if first else 0
            end = max(first + 1, int(np.searchsorted(ends, before + PART_BYTES, side="right")))
            yield batch.slice(first, end - first)
            first = end


def encode(docs: DataFrame, path: str, pattern: str, decode: bool = False) -> DataFrame:
    """The documents with `ids`, and with `decoded`, the ids' text, if asked for."""
    kept = [f for f in docs.schema.fields if f.name not in ("ids", "decoded")]
    added = [T.StructField("ids", T.ArrayType(T.IntegerType()))]
    if decode:
        added.append(T.StructField("decoded", T.StringType()))
    schema = T.StructType(kept + added)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = worker_encoder(path, pattern), worker_decoder(path) if decode else None
        for part in _parts(batches):
            texts = text_bytes(part.column(part.schema.get_field_index("text")))
            ids = id_lists([encoder(text.decode("utf-8", "replace")) for text in texts])
            columns = [part.column(part.schema.get_field_index(f.name)) for f in kept] + [ids]
            if decoder is not None:
                values, offsets = ids.values.to_numpy(), ids.offsets.to_numpy()
                spans = zip(offsets[:-1], offsets[1:], strict=True)
                columns.append(pa.array([decoder.decode(values[a:b].tolist()) for a, b in spans], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.mapInArrow(run, schema)


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Digests of the ids and of the text that they decode to, per document."""
    coded = encode(docs.select("doc_id", "text"), path, pattern, decode=True)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )

"""Byte-level BPE as a finite-state transducer, and streaming decoding."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .segments import balanced, cut

#: States kept before the transducer starts anew; with their transitions each takes about half a kilobyte.
STATES = 250_000
#: Pieces remembered in one generation; two generations are kept.
PIECES = 100_000
#: Pairs of tokens of which it is remembered whether they may follow each other.
PAIRS = 400_000
NO_TOKEN = -1


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their ranks, from lines of base64 and number."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Merges:
    """The vocabulary as merges: how each token is put together, and which tokens may be neighbours."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self._edges: dict[tuple[int, bool], list[tuple[bytes, int]]] = {}

    def parts(self, text: bytes, stop: int = 1) -> list[bytes]:
        """``text`` after merging, lowest rank first and leftmost first, down to ``stop`` parts."""
        parts = [text[i : i + 1] for i in range(len(text))]
        while len(parts) > stop:
            ranks = [self.ranks.get(a + b) for a, b in zip(parts, parts[1:])]
            least = min((r for r in ranks if r is not None), default=None)
            if least is None:
                break
            i = ranks.index(least)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def edge(self, token: int, right: bool) -> list[tuple[bytes, int]]:
        """The parts at one end of a token, smallest first, each with the rank of the merge that takes it in."""
        known = self._edges.get((token, right))
        if known is None:
            known, inner = [], self.bytes_of[token]
            while len(inner) > 1:
                inner = self.parts(whole := inner, 2)[-1 if right else 0]
                known.append((inner, self.ranks[whole]))
            known = self._edges[token, right] = known[::-1] + [(self.bytes_of[token], len(self.ranks) << 1)]
        return known

    def neighbours(self, left: int, right: int) -> bool:
        """Whether merging ``left`` and ``right`` as one text gives these two tokens again.

        It does unless a part at the end of the left token and one at the start of the right token
        merge with each other before either is taken in by its own token. Of equal ranks the merge
        further left comes first.
        """
        ends, starts = self.edge(left, True), self.edge(right, False)
        i = j = 0
        while True:
            (a, taken_a), (b, taken_b) = ends[i], starts[j]
            across = self.ranks.get(a + b)
            if across is not None and across < taken_a and across <= taken_b:
                return False
            if i == len(ends) - 1 and j == len(starts) - 1:
                return True
            if taken_a <= taken_b:
                i += 1
            else:
                j += 1


class Transducer:
    """Reads the bytes of one piece of text and emits its tokens.

    The tokens of a text are the one way to cut it into tokens of which all neighbours may follow each
    other; this holds for every start of the text too. Reading forward there are a few ways open: for
    each length of an unfinished token, the tokens before it. A state holds the open ways, without the
    tokens that they all begin with, which have been emitted. An open way ends when its unfinished
    token can become no token, so the lookahead is bounded by the longest token.

    The last emitted token is no part of a state, or there would be too many of them. It matters for the
    way that has nothing pending only: whether its unfinished token, if it is a token, may follow. So a
    transition is chosen by the byte and that answer. States and transitions are made when first needed;
    beyond ``STATES`` of them all are dropped, and made anew.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.merges = Merges(ranks)
        # Tokens that merging never forms stand only for a piece that equals them.
        self.whole = {t: r for t, r in ranks.items() if len(t) > 1 and self.merges.parts(t) != [t]}
        self.child: list[dict[int, int]] = [{}]
        self.token: list[int] = [NO_TOKEN]
        for text, rank in ranks.items():
            if text in self.whole:
                continue
            node = 0
            for byte in text:
                node = self.child[node].setdefault(byte, len(self.child))
                if node == len(self.child):
                    self.child.append({})
                    self.token.append(NO_TOKEN)
            self.token[node] = rank
        self.pairs: dict[int, bool] = {}
        self._restart()

    def _restart(self) -> None:
        self.numbers: dict[tuple, int] = {}
        #: Transitions by state and choice: the byte, or byte + 256 if the open token may not follow.
        self.steps: dict[int, tuple[int, tuple]] = {}
        #: By state: the open ways; the token of the way with nothing pending; and the tokens if the piece
        #: ends here, for both answers.
        self.ways: list[tuple] = []
        self.open: list[int] = []
        self.final: list[tuple[tuple | None, tuple | None]] = []
        self._state((((), 0),))
        self.final[0] = ((), ())

    def _may_follow(self, left: int, right: int) -> bool:
        if left == NO_TOKEN:
            return True
        key = left << 32 | right
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            known = self.pairs[key] = self.merges.neighbours(left, right)
        return known

    def _state(self, ways: tuple) -> int:
        number = self.numbers.get(ways)
        if number is None:
            number = self.numbers[ways] = len(self.ways)
            self.ways.append(ways)
            bare, other = NO_TOKEN, None
            for before, node in ways:
                token = self.token[node]
                if token == NO_TOKEN:
                    continue
                if not before:
                    bare = token
                elif other is None and self._may_follow(before[-1], token):
                    other = (*before, token)
            self.open.append(bare)
            self.final.append((other if bare == NO_TOKEN else (bare,), other))
        return number

    def _step(self, state: int, choice: int) -> tuple[int, tuple]:
        byte, child = choice & 255, self.child
        after = [(before, child[node][byte]) for before, node in self.ways[state] if byte in child[node]]
        ends = self.final[state][choice >> 8]
        if ends:
            after.append((ends, child[0][byte]))
        first = after[0][0]
        if len(after) == 1:
            shared = len(first)
        else:
            shared, least = 0, min([len(before) for before, _ in after])
            while shared < least and all([before[shared] == first[shared] for before, _ in after]):
                shared += 1
        if shared:
            after = [(before[shared:], node) for before, node in after]
        found = self.steps[state << 9 | choice] = (self._state(tuple(after)), first[:shared])
        return found

    def encode(self, piece: bytes) -> list[int]:
        if piece in self.whole:
            return [self.whole[piece]]
        if len(self.ways) > STATES:
            self._restart()
        state, last, tokens, steps, open_, pairs = 0, NO_TOKEN, [], self.steps.get, self.open, self.pairs.get
        for choice in piece:
            token = open_[state]
            if last >= 0 and token >= 0:
                follows = pairs(last << 32 | token)
                if follows is False or follows is None and not self._may_follow(last, token):
                    choice |= 256
            state, emitted = steps(state << 9 | choice) or self._step(state, choice)
            if emitted:
                tokens += emitted
                last = emitted[-1]
        token = open_[state]
        tokens += self.final[state][token != NO_TOKEN and not self._may_follow(last, token)]
        return tokens


class Decoder:
    """Bytes of token ids, and text from a stream of ids that may end inside a character."""

    def __init__(self, ranks: dict[bytes, int]):
        size = max(ranks.values()) + 1
        self.lengths, self.starts = np.zeros(size, np.int64), np.zeros(size, np.int64)
        at = 0
        for token, rank in ranks.items():
            self.lengths[rank], self.starts[rank] = len(token), at
            at += len(token)
        self.bytes = np.frombuffer(b"".join(ranks), np.uint8)

    def decode(self, ids: np.ndarray) -> bytes:
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        shift = np.repeat(self.starts[ids] - (ends - lengths), lengths)
        return self.bytes[np.arange(len(shift)) + shift].tobytes()

    def stream(self, chunks: Iterator[np.ndarray]) -> Iterator[str]:
        machine = Utf8()
        for ids in chunks:
            yield machine.feed(self.decode(ids))
        yield machine.feed(b"", end=True)


class Utf8:
    """An incremental UTF-8 state machine: text of the bytes so far, the rest is kept for the next call.

    The state is the bytes of an unfinished character. Bytes that can be part of no character
    become U+FFFD, as soon as that is certain.
    """

    def __init__(self):
        self.state = b""

    @staticmethod
    def _open(data: bytes) -> int:
        """How many bytes at the end are the start of a character that may still be finished."""
        for back in range(1, min(3, len(data)) + 1):
            lead = data[-back]
            if lead & 0xC0 == 0x80:
                continue
            need = 2 if 0xC2 <= lead <= 0xDF else 3 if 0xE0 <= lead <= 0xEF else 4 if 0xF0 <= lead <= 0xF4 else 1
            if need <= back:
                return 0
            # The second byte is narrowed by the first: no overlong forms, surrogates, or numbers too large.
            low = {0xE0: 0xA0, 0xF0: 0x90}.get(lead, 0x80)
            high = {0xED: 0x9F, 0xF4: 0x8F}.get(lead, 0xBF)
            return back if back == 1 or low <= data[-back + 1] <= high else 0
        return 0

    def feed(self, data: bytes, end: bool = False) -> str:
        data = self.state + data
        kept = 0 if end else self._open(data)
        self.state = data[len(data) - kept :]
        return data[: len(data) - kept].decode("utf-8", "replace")


class Pieces:
    """Ids of texts, piece by piece; the pieces met last are remembered."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.transducer, self.matches = Transducer(ranks), regex.compile(pattern)
        self.now: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _ids(self, piece: str) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            ids = np.array(self.transducer.encode(piece.encode()), "<u4").tobytes()
        if len(piece) <= 64:
            self.now[piece] = ids
        return ids

    def encode(self, text: str) -> bytes:
        found = []
        for stretch in cut(text):
            if len(self.now) > PIECES:
                self.old, self.now = self.now, {}
            known = self.now.get
            found += [known(p) or self._ids(p) for p in self.matches.findall(stretch)]
        return b"".join(found)


@cache
def _encoder(path: str, pattern: str) -> Pieces:
    return Pieces(read_ranks(path), pattern)


@cache
def _decoder(path: str) -> Decoder:
    return Decoder(read_ranks(path))


#: Ids that the decoder is given at a time.
CHUNK = 1 << 16


def encode(docs: DataFrame, path: str, pattern: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: its id and ``ids``, little-endian unsigned 32-bit integers of its whole text.

    Ids are those of the rank file ``path`` for each match of ``pattern`` in turn, without special tokens.
    A long text is encoded in stretches that end at safe places; one without such places, which lie before single
    spaces, is one stretch. A NULL or empty text has no ids; repeated rows are each returned, other columns left out.
    """

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _encoder(path, pattern)
        for batch in batches:
            for rows in balanced(batch, "text") if batch.num_rows else ():
                ids = pa.array([pieces.encode(t or "") for t in rows.column("text").to_pylist()], pa.binary())
                yield pa.RecordBatch.from_arrays([rows.column("id"), ids], ["id", "ids"])

    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    kind = docs.schema[id].dataType.simpleString()
    return rows.mapInArrow(encoded, f"id {kind}, ids binary").withColumnRenamed("id", id)


def decode(rows: DataFrame, path: str, id: str = "doc_id", ids: str = "ids", with_text: bool = True) -> DataFrame:
    """Per row: its id, ``n_tokens``, ``ids_sha256``, ``decoded_sha256`` (hex, of the bytes) and ``text``, if wanted.

    The ids are decoded in chunks, as a stream would bring them; ``text`` has U+FFFD for bytes that are no
    UTF-8. NULL ids count as none.
    """

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "n_tokens", "ids_sha256", "decoded_sha256", "text"]
        decoder = _decoder(path)
        for batch in batches:
            for part in balanced(batch, "ids") if batch.num_rows else ():
                found = []
                for raw in part.column("ids").to_pylist():
                    numbers = np.frombuffer(raw or b"", "<u4")
                    machine, digest, texts = Utf8(), hashlib.sha256(), []
                    for at in range(0, len(numbers), CHUNK):
                        data = decoder.decode(numbers[at : at + CHUNK])
                        digest.update(data)
                        texts.append(machine.feed(data))
                    texts.append(machine.feed(b"", end=True))
                    found.append((len(numbers), hashlib.sha256(raw or b"").hexdigest(), digest.hexdigest(), "".join(texts) if with_text else None))
                columns = [pa.array(c, t) for c, t in zip(zip(*found), (pa.int64(), pa.string(), pa.string(), pa.string()))]
                yield pa.RecordBatch.from_arrays([part.column("id"), *columns], names)

    given = rows.select(F.col(id).alias("id"), F.col(ids).alias("ids"))
    kind = rows.schema[id].dataType.simpleString()
    schema = f"id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string, text string"
    return given.mapInArrow(decoded, schema).withColumnRenamed("id", id)

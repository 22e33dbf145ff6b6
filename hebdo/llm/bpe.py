"""Byte-level BPE as a finite-state transducer, and streaming decoding.

The merges (a rank per token) are compiled into a transducer over bytes that is determinised
lazily. After some bytes of a piece, every prefix has one encoding, and its last token and
that token's start form a tree over the positions; what later bytes can change lies below the
last common ancestor of the positions from which a token may still continue. A state is
therefore (last settled token, the bytes after it); reading a byte settles the tokens above the
new common ancestor and emits them, after a lookahead bounded by the longest token. A transition
is made when a text needs it for the second time and shared by all later texts; the first time,
the rest of the piece is walked from the state without making others.

Which token ends a prefix is unique: the one that is compatible with the token before it, that
is, the text of the two encodes to just them.
"""

from __future__ import annotations

import base64
import gc
import hashlib
import struct
import threading
import time
from collections.abc import Iterable, Iterator
from itertools import islice

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from hebdo.llm.common import ship_package
from hebdo.llm.textbytes import give_back

#: Pieces in a generation of the cache (about 200 bytes each), and states of the transducer
#: (about 1 KB each) before they are remade: at most 220 MB in each Python worker.
CACHE_PIECES = 400_000
MAX_STATES = 60_000
#: Longer pieces (bytes or characters) are not kept.
LONG_PIECE = 128
#: Characters of texts that are split together, and pieces or tokens that are held at a time.
CHARS_AT_ONCE = 2_000_000
PIECES_AT_ONCE = 200_000


def read_ranks(path: str) -> dict[bytes, int]:
    """The token bytes and ranks of a rank file (base64 token, space, rank on each line)."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


class Transducer:
    """Encodes one piece (a match of the splitting pattern) of UTF-8 bytes into token ids."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        # the tokens' bytes as a trie: node and byte -> node; the token that ends at a node
        self._child: dict[int, int] = {}
        self._token_at: list[int] = [-1]
        for text, rank in ranks.items():
            node = 0
            for byte in text:
                node = self._child.setdefault(node << 8 | byte, len(self._token_at))
                if node == len(self._token_at):
                    self._token_at.append(-1)
            self._token_at[node] = rank
        self._pairs: dict[int, bool] = {}
        self._split: dict[int, tuple[int, int] | None] = {}
        self._reset()

    def _reset(self) -> None:
        # a state: settled token or -1, bytes after it, the positions from which a token may go
        # on with their trie nodes, and for each position the start and number of the token
        # that ends there
        self._states = [(-1, b"", ((0, 0),), (0,), (-1,))]
        self._numbers = {(-1, b""): 0}
        self._next: dict[int, tuple[int, tuple[int, ...]]] = {}  # state and byte -> state, output
        self._ends: dict[int, tuple[int, ...]] = {}
        self._asked: set[int] = set()  # transitions that were walked once and not made

    def merge(self, piece: bytes, below: int = 1 << 60) -> list[int]:
        """The merges with a rank under ``below``, lowest first (for short byte strings)."""
        parts = [piece[i:i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            rank, i = min((self.ranks.get(parts[i] + parts[i + 1], below), i) for i in range(len(parts) - 1))
            if rank >= below:
                break
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return [self.ranks[p] for p in parts]

    def _halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens that the merge making ``token`` joins; None for a single byte. A token
        that its own text does not encode to has no such pair and is marked (-1, -1)."""
        if token not in self._split:
            text = self.tokens[token]
            parts = self.merge(text, below=token)
            self._split[token] = None if len(text) == 1 else tuple(parts) if len(parts) == 2 else (-1, -1)
        return self._split[token]

    def _compatible(self, left: int, right: int) -> bool:
        """Does the text of the two tokens (left: -1 at the beginning) encode to just them? Going
        down both tokens' merges along the seam, no merge across it may come before those that
        made the tokens."""
        key = left << 32 | right
        if key not in self._pairs:
            if left < 0 or self._halves(right) == (-1, -1):
                self._pairs[key] = self._halves(right) != (-1, -1)
                return self._pairs[key]
            a, b, limit = left, right, 1 << 60
            while True:
                across = self.ranks.get(self.tokens[a] + self.tokens[b])
                if across is not None and across < limit:
                    self._pairs[key] = False
                    break
                # the token made last came apart last: take it apart first
                if a > b:
                    limit, halves = a, self._halves(a)
                    if halves is not None:
                        a = halves[1]
                        continue
                    limit, halves = b + 1, self._halves(b)
                    if halves is None:
                        self._pairs[key] = True
                        break
                    b = halves[0]
                else:
                    limit, halves = b + 1, self._halves(b)
                    if halves is not None:
                        b = halves[0]
                        continue
                    limit, halves = a, self._halves(a)
                    if halves is None:
                        self._pairs[key] = True
                        break
                    a = halves[1]
        return self._pairs[key]

    def _step(self, number: int, byte: int) -> tuple[int, tuple[int, ...]]:
        """The transition on a byte: determinised now, remembered in ``_next``."""
        settled, tail, live, starts, tokens = self._states[number]
        child, token_at, pairs = self._child.get, self._token_at, self._pairs.get
        end, going = -1, []
        for start, node in live:  # longest token first; one alone fits
            node = child(node << 8 | byte)
            if node is not None:
                going.append((start, node))
                if end < 0 and (token := token_at[node]) >= 0:
                    left = tokens[start] if start else settled
                    fits = pairs(left << 32 | token)
                    if fits or fits is None and self._compatible(left, token):
                        end, last = start, token
        if end < 0:
            raise ValueError(f"no token ends with byte {byte}: the rank file lacks single bytes")
        tail += bytes((byte,))
        n = common = len(tail)
        starts += (end,)
        tokens += (last,)
        for p, _ in going:  # last position that every path passes
            while p != common:
                if p > common:
                    p = starts[p]
                else:
                    common = starts[common]
        emitted = ()
        if common:
            emitted = self._path(starts, tokens, common)
            settled, tail = emitted[-1], tail[common:]
        to = self._numbers.get((settled, tail))
        if to is None:
            to = self._numbers[settled, tail] = len(self._states)
            going.append((n, 0))
            if common:
                going = [(p - common, node) for p, node in going]
                starts = (0, *[p - common for p in starts[common + 1:]])
                tokens = (-1, *tokens[common + 1:])
            self._states.append((settled, tail, tuple(going), starts, tokens))
        self._next[number << 8 | byte] = (to, emitted)
        return to, emitted

    @staticmethod
    def _path(starts: tuple, tokens: tuple, p: int) -> tuple[int, ...]:
        """The tokens from the settled one to position ``p``."""
        path = []
        while p:
            path.append(tokens[p])
            p = starts[p]
        return tuple(path[::-1])

    def _end(self, number: int) -> tuple[int, ...]:
        """What a state still emits when the piece ends."""
        if number not in self._ends:
            _, tail, _, starts, tokens = self._states[number]
            self._ends[number] = self._path(starts, tokens, len(tail))
        return self._ends[number]

    def encode_sorted(self, pieces: list[bytes]) -> list[tuple[int, ...]]:
        """The ids of each piece. Sorted pieces share the run over what two neighbours begin with."""
        if len(self._states) > MAX_STATES:
            self._reset()
        if len(self._asked) > MAX_STATES:
            self._asked.clear()
        known, step, asked = self._next.get, self._step, self._asked
        before, states, outputs, result = b"", [0], [()], []
        for piece in pieces:
            whole = self.ranks.get(piece)
            if whole is not None:  # a piece that is a token is that token
                result.append((whole,))
                continue
            if len(piece) > LONG_PIECE:  # outputs after each byte would grow with its square
                result.append(self._walk(0, piece))
                continue
            shared, most = 0, min(len(before), len(piece))
            while shared < most and before[shared] == piece[shared]:
                shared += 1
            shared = min(shared, len(states) - 1)
            del states[shared + 1:], outputs[shared + 1:]
            state, out = states[shared], outputs[shared]
            for at in range(shared, len(piece)):
                key = state << 8 | piece[at]
                to = known(key)
                if to is None:
                    if key not in asked:
                        asked.add(key)
                        out += self._walk(state, piece[at:])
                        break
                    to = step(state, piece[at])
                state, emitted = to
                if emitted:
                    out += emitted
                states.append(state)
                outputs.append(out)
            else:
                out += self._end(state)
            result.append(out)
            before = piece
        return result

    def _walk(self, number: int, rest: bytes) -> tuple[int, ...]:
        """What the rest of a piece emits from a state, without making states on the way."""
        settled, tail, live, starts, tokens = self._states[number]
        child, token_at, pairs = self._child.get, self._token_at, self._pairs.get
        starts, tokens, n = list(starts), list(tokens), len(tail)
        for byte in rest:
            end, going = -1, []
            for start, node in live:
                node = child(node << 8 | byte)
                if node is not None:
                    going.append((start, node))
                    if end < 0 and (token := token_at[node]) >= 0:
                        left = tokens[start] if start else settled
                        fits = pairs(left << 32 | token)
                        if fits or fits is None and self._compatible(left, token):
                            end, last = start, token
            if end < 0:
                raise ValueError(f"no token ends with byte {byte}: the rank file lacks single bytes")
            n += 1
            starts.append(end)
            tokens.append(last)
            going.append((n, 0))
            live = going
        return self._path(starts, tokens, n)


def pack(ids: tuple[int, ...]) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    return struct.pack(f"<{len(ids)}I", *ids)


class Encoder:
    """Whole texts to ids: the pattern splits, the transducer encodes each piece once.

    Packed ids of pieces are kept in two generations: when the newer one is full, it becomes
    the older one, and what is asked for again moves back.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.split = regex.compile(pattern)
        self.transducer = Transducer(ranks)
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _learn(self, pieces: set[str]) -> None:
        """Have the packed ids of all ``pieces`` in the newer generation."""
        if len(self.new) >= CACHE_PIECES:
            self.old, self.new = self.new, {}
        missing = []
        for piece in pieces.difference(self.new):
            packed = self.old.get(piece)
            if packed is None:
                missing.append(piece.encode())
            else:
                self.new[piece] = packed
        missing.sort()
        for piece, ids in zip(missing, self.transducer.encode_sorted(missing), strict=True):
            self.new[piece.decode()] = pack(ids)

    def encode_all(self, texts: Iterable[str]) -> Iterator[bytes]:
        """The ids of each text, packed. Texts are taken together up to CHARS_AT_ONCE; of a
        longer one, some pieces at a time."""
        held, chars = [], 0
        for text in texts:
            if chars and chars + len(text) > CHARS_AT_ONCE:
                yield from self._encode_held(held)
                held, chars = [], 0
            if len(text) > CHARS_AT_ONCE:
                found, out = (m.group() for m in self.split.finditer(text)), []
                while some := list(islice(found, PIECES_AT_ONCE)):
                    out += self._encode_held([some])
                yield b"".join(out)
            else:
                held.append(self.split.findall(text))
                chars += len(text)
        yield from self._encode_held(held)

    def _encode_held(self, held: list[list[str]]) -> Iterator[bytes]:
        pieces = set().union(*held)
        self._learn(pieces)
        look = self.new.__getitem__
        for each in held:
            yield b"".join(map(look, each))
        for piece in pieces:
            if len(piece) > LONG_PIECE:
                del self.new[piece]

    def encode(self, text: str) -> bytes:
        """The ids of one text, packed as little-endian unsigned 32-bit integers."""
        return next(self.encode_all([text]))


class Utf8Stream:
    """Incremental UTF-8 decoding of byte chunks that may end inside a character.

    The state is the unfinished character's bytes, at most three; malformed bytes become
    U+FFFD as in ``bytes.decode(errors="replace")``.
    """

    def __init__(self):
        self.held = b""

    def feed(self, chunk: bytes) -> str:
        data = self.held + chunk
        cut = len(data)
        for back in range(1, min(3, len(data)) + 1):
            lead = data[-back]
            if lead & 0xC0 == 0x80:  # a continuation byte: its lead comes earlier
                continue
            need = 4 if 0xF0 <= lead <= 0xF4 else 3 if 0xE0 <= lead <= 0xEF else 2 if 0xC2 <= lead <= 0xDF else 1
            if need > back and self._can_continue(data[len(data) - back:]):
                cut = len(data) - back
            break
        self.held = data[cut:]
        return data[:cut].decode("utf-8", "replace")

    @staticmethod
    def _can_continue(part: bytes) -> bool:
        """Is the unfinished sequence the beginning of a valid character? (second-byte ranges)"""
        if len(part) == 1:
            return True
        lead, second = part[0], part[1]
        low = 0xA0 if lead == 0xE0 else 0x90 if lead == 0xF0 else 0x80
        high = 0x9F if lead == 0xED else 0x8F if lead == 0xF4 else 0xBF
        return low <= second <= high

    def end(self) -> str:
        rest, self.held = self.held, b""
        return rest.decode("utf-8", "replace")


class Decoder:
    def __init__(self, ranks: dict[bytes, int]):
        self.token = {rank: token for token, rank in ranks.items()}

    def chunks(self, packed: bytes, at_once: int = PIECES_AT_ONCE) -> Iterator[bytes]:
        """The bytes of packed ids, some tokens at a time."""
        ids = memoryview(packed).cast("I")
        for k in range(0, len(ids), at_once):
            yield b"".join(map(self.token.__getitem__, ids[k:k + at_once].tolist()))

    def stream(self, packed: bytes, at_once: int = PIECES_AT_ONCE) -> Iterator[str]:
        """The characters of packed ids, as far as each chunk completes them."""
        stream = Utf8Stream()
        for chunk in self.chunks(packed, at_once):
            yield stream.feed(chunk)
        yield stream.end()

    def text(self, packed: bytes, at_once: int = PIECES_AT_ONCE) -> str:
        return "".join(self.stream(packed, at_once))


_LOADED: dict[tuple[str, str], tuple[Encoder, Decoder]] = {}
#: Spark keeps idle Python workers, and with them what they hold: after so many seconds without
#: use a worker lets its codecs (some 250 MB) go.
IDLE_SECONDS = 5.0
_last_use = [0.0]


def loaded(path: str, pattern: str) -> tuple[Encoder, Decoder]:
    """The codec of this Python worker: read once, its states kept from batch to batch and from
    task to task, until the worker has been idle for a while."""
    _last_use[0] = time.monotonic()
    if (path, pattern) not in _LOADED:
        if not _LOADED:
            threading.Thread(target=_let_go_when_idle, daemon=True).start()
        ranks = read_ranks(path)
        _LOADED[path, pattern] = Encoder(ranks, pattern), Decoder(ranks)
    return _LOADED[path, pattern]


def _let_go_when_idle() -> None:
    while time.monotonic() - _last_use[0] < IDLE_SECONDS:
        time.sleep(1.0)
    _LOADED.clear()  # a task that still encodes holds its own reference
    give_back()


def encode_documents(docs: DataFrame, path: str, pattern: str, with_ids: bool = False) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256 and, if asked, ids
    (packed little-endian 32-bit). The ids are decoded again, through
    the UTF-8 stream, for decoded_sha256: the hash of the characters it emits.

    Null text counts as empty: no tokens, the hash of no bytes. Repeated rows give repeated
    rows; other columns are not read; an empty table gives none. ``path`` must name the same
    rank file on every executor.
    """

    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = loaded(path, pattern)
        gc.disable()  # the states are many small tuples without cycles: scanning them doubles the time
        for batch in batches:
            n, ids_sha, text_sha, ids = [], [], [], []
            for packed in encoder.encode_all(value.as_py() or "" for value in batch.column(1)):
                n.append(len(packed) // 4)
                ids_sha.append(hashlib.sha256(packed).hexdigest())
                decoded = hashlib.sha256()
                for characters in decoder.stream(packed):
                    decoded.update(characters.encode())
                text_sha.append(decoded.hexdigest())
                if with_ids:
                    ids.append(packed)
            _last_use[0] = time.monotonic()
            cols = {"doc_id": batch.column(0), "n_tokens": pa.array(n, pa.int64()),
                    "ids_sha256": pa.array(ids_sha, pa.string()), "decoded_sha256": pa.array(text_sha, pa.string())}
            if with_ids:
                cols["ids"] = pa.array(ids, pa.binary())
            yield pa.RecordBatch.from_pydict(cols)
        gc.enable()
        give_back()

    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.select("doc_id", "text").mapInArrow(run, schema + ", ids binary" * with_ids)


def decode_documents(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and text of rows with doc_id and packed ids; null ids give null text."""

    ship_package(encoded.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, decoder = loaded(path, pattern)
        for batch in batches:
            texts = [None if v is None else decoder.text(v) for v in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "text": pa.array(texts, pa.string())})

    id_type = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {id_type}, text string")

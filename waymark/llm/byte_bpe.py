"""Byte-level BPE: merges compiled into a lazily determinised transducer; streaming decode.

A token sequence is the BPE encoding of its bytes exactly if every token, and every pair of neighbours, encodes to
itself: no merge crosses a border in the end, so each stretch between borders evolves as it would alone. Encoding is
thus a local condition, which a non-deterministic transducer checks: its states are a place in the trie of tokens
together with the last token finished. ``Transducer`` determinises it while it reads: a state of the result is the
set of live places, and a step gives out the token that ends the one encoding of the bytes so far. Live places have
their earlier tokens in common up to a border at most a few longest tokens back, so the tokens before it are final;
``stream`` gives them out window by window. Every step is memoised, so known states cost one lookup per byte, and a
piece of any length takes linear time.

Decoding maps ids to bytes and passes them through ``Utf8Stream``, which gives out whole characters and holds back at
most three bytes, so a stream can be decoded token by token.

Defined results: null and empty texts have no tokens; text that isn't UTF-8 has U+FFFD in place of bad bytes; special
tokens are ordinary text. Rows are independent, so ties, repeated rows and an empty table need no rule. Input columns
other than the key and the text are ignored.
"""

from __future__ import annotations

import base64
import gc
import hashlib
from array import array
from collections.abc import Iterable, Iterator, Sequence
from functools import cached_property
from itertools import batched, chain, pairwise

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: States of the determinised transducer, and pieces, kept by a worker; beyond, they start anew. Results don't depend
#: on either.
MAX_STATES = 130_000
MAX_PIECES = 165_000
#: Bytes after which the tokens agreed on are given out.
WINDOW = 1024
#: Bytes decoded at a time.
GROUP = 65_536


def read_ranks(lines: Iterable[bytes]) -> dict[bytes, int]:
    """Ranks from lines of a base64 token and its rank."""
    pairs = (line.split() for line in lines if line.strip())
    return {base64.b64decode(token): int(rank) for token, rank in pairs}


_NEVER = 1 << 62


def merges(data: bytes, ranks: dict[bytes, int]) -> tuple[list[bytes], list[tuple[int, bytes, bytes]]]:
    """Merges applied one by one, lowest rank and then leftmost first.

    Gives the parts left in the end, and for every moment the rank of the next merge with the first and last part.
    """
    parts = [data[k:k + 1] for k in range(len(data))]
    pairs = [ranks.get(data[k:k + 2], _NEVER) for k in range(len(data) - 1)]
    moments = []
    while True:
        low = min(pairs, default=_NEVER)
        moments.append((low, parts[0], parts[-1]))
        if low == _NEVER:
            return parts, moments
        at = pairs.index(low)
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
        del pairs[at]
        if at < len(pairs):
            pairs[at] = ranks.get(parts[at] + parts[at + 1], _NEVER)
        if at:
            pairs[at - 1] = ranks.get(parts[at - 1] + parts[at], _NEVER)


class Transducer:
    """Bytes of a piece in, token ids out."""

    def __init__(self, ranks: dict[bytes, int], max_states: int = MAX_STATES):
        self.ranks, self.max_states = ranks, max_states
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.trie: list[dict[int, int]] = [{}]
        self.token: list[int] = [-1]
        self.depth: list[int] = [0]
        for token, rank in ranks.items():
            node = 0
            for byte in token:
                nxt = self.trie[node].get(byte)
                if nxt is None:
                    nxt = self.trie[node][byte] = len(self.trie)
                    self.trie.append({})
                    self.token.append(-1)
                    self.depth.append(self.depth[node] + 1)
                node = nxt
            self.token[node] = rank
        self.size = {rank: len(token) for token, rank in ranks.items()}
        self._fits: dict[int, bool] = {}  # by both tokens in one number, which takes a third of a tuple's memory
        self._moments: dict[int, list | None] = {}
        self._reset()

    def _reset(self) -> None:
        self.states: dict[tuple, dict] = {}
        self.start = self._state(((0, -1),))

    def _state(self, places: tuple) -> dict:
        """A state: its live places under -1, and under each byte met so far the next state and the token ending there."""
        state = self.states.get(places)
        if state is None:
            state = self.states[places] = {-1: places}
        return state

    def _alone(self, token: int) -> list | None:
        """The moments of a token's own merges; None if it doesn't encode to itself."""
        known = self._moments.get(token, 0)
        if known == 0:
            parts, moments = merges(self.bytes_of[token], self.ranks)
            known = self._moments[token] = moments if len(parts) == 1 else None
        return known

    def fits(self, last: int, token: int) -> bool:
        """Whether ``token`` may follow ``last`` (-1: nothing).

        Both sides merge as they would alone, in order of rank, unless a merge across the border comes first.
        """
        right = self._alone(token)
        if last < 0 or right is None:
            return right is not None
        pair = last << 32 | token
        known = self._fits.get(pair)
        if known is None:
            left, a, b, get = self._alone(last), 0, 0, self.ranks.get
            while True:
                (low_a, _, tail), (low_b, head, _) = left[a], right[b]
                across = get(tail + head, _NEVER)
                if across < low_a and across <= low_b:
                    known = False
                    break
                if low_a <= low_b:
                    if low_a == _NEVER:
                        known = True
                        break
                    a += 1
                else:
                    b += 1
            if len(self._fits) >= 2 * self.max_states:
                self._fits.clear()
            self._fits[pair] = known
        return known

    def _step(self, state: dict, byte: int) -> tuple[dict, int]:
        """The next state, and the last token of the one encoding of the bytes so far."""
        live, done, trie, token_at, known = [], -1, self.trie, self.token, self._fits
        for node, last in state[-1]:
            nxt = trie[node].get(byte)
            if nxt is None:
                continue
            if trie[nxt]:
                live.append((nxt, last))
            if done < 0 and (token := token_at[nxt]) >= 0:
                fit = known.get((last, token))
                if self.fits(last, token) if fit is None else fit:
                    done = token
        live.append((0, done))
        if len(self.states) >= self.max_states:
            self._reset()
            return self._state(tuple(live)), done
        found = state[byte] = self._state(tuple(live)), done
        return found

    def _agreed(self, state: dict, ends: list[int]) -> int:
        """The latest border that all live places have behind them; ``ends`` has the token that ends at each byte."""
        at, depth, size = len(ends), self.depth, self.size
        borders = {at - depth[node] for node, _ in state[-1]}
        while len(borders) > 1:
            last = max(borders)
            borders.remove(last)
            borders.add(last - size[ends[last - 1]])
        return borders.pop()

    def _back(self, ends: list[int], border: int) -> list[int]:
        """The tokens up to a border."""
        out, size = [], self.size
        while border:
            token = ends[border - 1]
            out.append(token)
            border -= size[token]
        out.reverse()
        return out

    def stream(self, data: bytes, window: int = WINDOW) -> Iterator[list[int]]:
        """Tokens of a piece, given out after every ``window`` bytes as far as all live places agree."""
        state, ends, step = self.start, [], self._step
        for first in range(0, len(data), window):
            for byte in data[first:first + window]:
                try:
                    state, token = state[byte]
                except KeyError:
                    state, token = step(state, byte)
                ends.append(token)
            border = self._agreed(state, ends) if first + window < len(data) else len(ends)
            yield self._back(ends, border)
            del ends[:border]

    def encode(self, piece: bytes) -> list[int]:
        if len(piece) > WINDOW:
            return list(chain.from_iterable(self.stream(piece)))
        state, ends, step = self.start, [], self._step
        for byte in piece:
            try:
                state, token = state[byte]
            except KeyError:
                state, token = step(state, byte)
            ends.append(token)
        return self._back(ends, len(ends))


class _Pieces(dict):
    """Ids of each piece as 32-bit numbers, encoded when first met. When full, it keeps what it held for one more round."""

    def __init__(self, transducer: Transducer):
        super().__init__()
        self.transducer, self.older = transducer, {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            ids = array("i", self.transducer.encode(piece.encode("utf-8"))).tobytes()
        if len(piece) <= 64:
            if len(self) >= MAX_PIECES:
                self.older = dict(self)
                self.clear()
            self[piece] = ids
        return ids


class Utf8Stream:
    """Characters of a byte stream, as soon as they are complete; bad bytes become U+FFFD."""

    def __init__(self):
        self.held = b""

    @staticmethod
    def _open(tail: bytes) -> int:
        """How many last bytes begin a character that may still be completed."""
        for back in range(1, min(3, len(tail)) + 1):
            byte = tail[-back]
            if byte < 0x80:
                return 0
            if byte >= 0xC2:
                need = 2 if byte < 0xE0 else 3 if byte < 0xF0 else 4 if byte < 0xF5 else 0
                if need <= back:
                    return 0
                low, high = {0xE0: (0xA0, 0xBF), 0xED: (0x80, 0x9F), 0xF0: (0x90, 0xBF), 0xF4: (0x80, 0x8F)}.get(
                    byte, (0x80, 0xBF))
                return back if back == 1 or low <= tail[1 - back] <= high else 0
            if byte >= 0xC0:
                return 0
        return 0

    def feed(self, data: bytes) -> str:
        data = self.held + data
        cut = len(data) - self._open(data[-3:])
        self.held = data[cut:]
        return data[:cut].decode("utf-8", "replace")

    def close(self) -> str:
        rest, self.held = self.held, b""
        return rest.decode("utf-8", "replace")


class _Strings:
    """A byte string for every id, joined for whole arrays of ids."""

    def __init__(self, of: dict[int, bytes]):
        self.table = pa.array([of.get(k) for k in range(max(of, default=-1) + 1)], pa.large_binary())

    def joined(self, ids: pa.Array) -> tuple[memoryview, np.ndarray]:
        """The strings of all ids one after the other, and where each begins (n + 1 numbers)."""
        found = self.table.take(ids)
        if found.null_count:
            raise KeyError("an id without a token")
        _, ends, data = found.buffers()
        return memoryview(data or b""), np.frombuffer(ends, np.int64, len(found) + 1, found.offset * 8)


class Codec:
    """Texts to ids and back. ``pattern`` splits a text into the pieces that are encoded by themselves."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.split = regex.compile(pattern).findall

    @cached_property
    def pieces(self) -> _Pieces:
        return _Pieces(Transducer(self.ranks))

    @cached_property
    def tokens(self) -> _Strings:
        return _Strings({rank: token for token, rank in self.ranks.items()})

    @cached_property
    def numbers(self) -> _Strings:
        return _Strings({rank: b"%d," % rank for rank in self.ranks.values()})

    def ids(self, text: str) -> np.ndarray:
        return np.frombuffer(b"".join(map(self.pieces.__getitem__, self.split(text))), np.int32)

    def encode(self, text: str) -> list[int]:
        return self.ids(text).tolist()

    def decode(self, ids: Iterable[int]) -> bytes:
        return bytes(self.tokens.joined(pa.array(ids, pa.int32()))[0])

    def decode_stream(self, ids: Iterable[int], group: int = 4096) -> Iterator[str]:
        """Text of a stream of ids, ``group`` ids at a time; characters are never cut."""
        return characters(self.decode(part) for part in batched(ids, group))


def characters(parts: Iterable[bytes]) -> Iterator[str]:
    """Text of a stream of bytes."""
    stream = Utf8Stream()
    for part in parts:
        yield stream.feed(part)
    yield stream.close()


_codecs: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    """The codec of a rank file, made once in each Python worker."""
    if (path, pattern) not in _codecs:
        with open(path, "rb") as lines:
            _codecs[path, pattern] = Codec(read_ranks(lines), pattern)
        gc.freeze()  # the tables stay; the collector need not walk them again and again
    return _codecs[path, pattern]


def _texts(column: pa.Array) -> Iterator[str]:
    for value in column:
        raw = value.as_buffer()
        yield "" if raw is None else raw.to_pybytes().decode("utf-8", "replace")


def _encoder(path: str, pattern: str, key: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = codec(path, pattern).ids
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                ids = [encode(t) for t in _texts(part.column(1))]
                n = np.array([len(x) for x in ids], np.int64)
                ends = np.concatenate(([0], np.cumsum(n))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n), pa.ListArray.from_arrays(ends, np.concatenate(ids))],
                    names=[key, "n_tokens", "ids"])

    return run


def _decoder(path: str, pattern: str, key: str, keep: Sequence[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                sums, texts, hashes = [], [], []
                lists = part.column(2)
                rows, ids = lists.offsets.to_numpy() - lists.offsets[0].as_py(), lists.flatten()
                numbers, at = own.numbers.joined(ids)
                data, ends = own.tokens.joined(ids)
                for low, high in pairwise(rows):
                    sums.append(hashlib.sha256(numbers[at[low]:max(at[high] - 1, at[low])]).hexdigest())
                    begin, end = int(ends[low]), int(ends[high])
                    text = "".join(characters(bytes(data[k:min(k + GROUP, end)]) for k in range(begin, end, GROUP)))
                    hashes.append(hashlib.sha256(text.encode()).hexdigest())
                    if "decoded" in keep:
                        texts.append(text)
                columns = {key: part.column(0), "n_tokens": part.column(1), "ids_sha256": pa.array(sums, pa.string()),
                           "decoded_sha256": pa.array(hashes, pa.string())}
                extra = {"ids": lists, "decoded": pa.array(texts, pa.string())}
                yield pa.RecordBatch.from_pydict(columns | {c: extra[c] for c in keep})

    return run


def _decoded_kinds(kind: str, key: str, keep: Sequence[str]) -> str:
    kinds = {key: kind, "n_tokens": "long", "ids_sha256": "string", "decoded_sha256": "string"} | {
        c: {"ids": "array<int>", "decoded": "string"}[c] for c in keep}
    return ", ".join(f"`{c}` {kind}" for c, kind in kinds.items())


def _source(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(f"`{key}`"), F.col(f"`{text}`").cast("binary").alias("__text"))


def encoded(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, n_tokens and ids of every document."""
    source = _source(docs, key, text)
    kind = source.schema[0].dataType.simpleString()
    return source.mapInArrow(_encoder(path, pattern, key), f"`{key}` {kind}, n_tokens long, ids array<int>")


def decoded(tokens: DataFrame, path: str, pattern: str, key: str = "doc_id",
            keep: Sequence[str] = ("ids", "decoded")) -> DataFrame:
    """``key``, n_tokens, checksums of the ids and of the decoded bytes, and of ids and decoded text those in ``keep``."""
    source = tokens.select(F.col(f"`{key}`"), "n_tokens", "ids")
    kind = source.schema[0].dataType.simpleString()
    return source.mapInArrow(_decoder(path, pattern, key, keep), _decoded_kinds(kind, key, keep))


def round_trip(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text",
               keep: Sequence[str] = ("ids", "decoded")) -> DataFrame:
    """``decoded`` of ``encoded``, in one Python worker a task instead of two, and without sending ids back and forth."""
    source = _source(docs, key, text)
    kind = source.schema[0].dataType.simpleString()
    encode, decode = _encoder(path, pattern, key), _decoder(path, pattern, key, keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from decode(encode(batches))

    return source.mapInArrow(run, _decoded_kinds(kind, key, keep))

"""Exact repeats by suffix arrays: bytes of any ``LENGTH``-byte string that also starts earlier are removed.

Finding who must be compared: every window of LENGTH bytes has an anchor, its smallest hash of ``GRAM`` bytes
(rightmost if equal), so equal windows have equal anchors. Consecutive windows with one anchor are a run; its bytes are
the run's context. Anchors met once in the corpus have no repeats. Of runs with equal anchor and context all but the
first are repeats as a whole, which a task settles for its own texts before the shuffle, so that what all documents
share is one row a task. Only anchors with different contexts are left: these contexts, once each, are dealt by anchor
over shards, and a shard's suffix array and permuted common prefixes tell which windows repeat an earlier one.

Bytes of different anchors never need to meet, so there is no global array; a task holds shards of about
``SHARD_BYTES``. Contexts of an anchor that has more than that are taken apart into windows, which meet by anchor and
window hash: a task settles those of its own texts before the shuffle, and the rest stream past in order.

Documents are ordered by key; nulls come last; rows equal in key are ordered by a hash of 64 bits of text and key, and
rows equal in key and text are one document, each of them returned. Null and empty texts have nothing to remove. An empty
table
gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.llm.suffix_arrays import common_prefixes, suffix_array
from waymark.llm.tables import written
from waymark.llm.text import Chunk, chunks, mixed

LENGTH = 100
GRAM = 32
SHARD_BYTES = 4_000_000
HOT_WINDOWS = 1 << 20  # windows of hot anchors that a task holds before it settles them
_LAST = (1 << 63) - 1

ROW = "h long, ctx long, doc long, sig long, pos long, n int"
MARK = "need boolean, h long, doc long, sig long, pos long, n int"


def _smallest(values: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Value and place of the smallest of each ``width`` values; the rightmost if equal."""
    place = np.arange(len(values), dtype=np.int32)
    span, low, at = 1, values, place

    def joined(low, at, gap):
        a, b = low[:-gap], low[gap:]
        right = b <= a
        return np.where(right, b, a), np.where(right, at[gap:], at[:-gap])

    while span * 2 <= width:
        low, at = joined(low, at, span)
        span *= 2
    return joined(low, at, width - span) if width > span else (low, at)


def runs(chunk: Chunk, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Document, first window (byte of the chunk), number of windows, anchor hash and context hash of each run."""
    size = len(chunk.data)
    none = tuple(np.zeros(0, np.int64) for _ in range(3)) + (np.zeros(0, np.uint64),) * 2
    if size < length:
        return none
    edge = np.zeros(size + 1, np.int32)
    long = chunk.ends - chunk.starts >= length
    np.add.at(edge, chunk.starts[long], 1)
    np.add.at(edge, chunk.ends[long] - length + 1, -1)
    windows = np.flatnonzero(np.cumsum(edge[:-1]) > 0)
    if not len(windows):
        return none
    at = np.arange(size - gram + 1)
    grams = chunk.hashes(at, at + gram)
    low, place = _smallest(grams, length - gram + 1)
    low, place = low[windows], place[windows]
    new = np.append(True, (place[1:] != place[:-1]) | (windows[1:] != windows[:-1] + 1))
    begin = np.flatnonzero(new)
    count = np.diff(np.append(begin, len(windows)))
    first = windows[begin]
    context = chunk.hashes(first, first + count + length - 1)
    context = mixed(context ^ ((place[begin] - first).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                               + count.astype(np.uint64)))
    doc = np.searchsorted(chunk.starts, first, "right") - 1
    return doc, first, count, low[begin], context


def _merged(doc: np.ndarray, sig: np.ndarray, pos: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, ...]:
    """Spans (document, its hash, start, bytes) with overlapping and touching ones joined."""
    if not len(doc):
        return doc, sig, pos, size
    order = np.lexsort((pos, sig, doc))
    doc, sig, pos, size = doc[order], sig[order], pos[order], size[order]
    end = pos + size
    apart = np.append(True, (doc[1:] != doc[:-1]) | (sig[1:] != sig[:-1]))
    base = (np.cumsum(apart) - 1) * (int(end.max()) + 1)  # each document's spans lie above those before
    reach = np.maximum.accumulate(end + base)
    at = np.flatnonzero(apart | np.append(True, (pos + base)[1:] > reach[:-1]))
    return doc[at], sig[at], pos[at], np.maximum.reduceat(end, at) - pos[at]


def _repeats(keys: list[np.ndarray], places: list[np.ndarray], last: tuple | None = None
             ) -> tuple[np.ndarray, np.ndarray, tuple | None]:
    """Of rows sorted by key and place: which are their key's first, which have the key from another place, and the
    last key with its first place, to go on with. What is neither has its key's first place once more."""
    n = len(keys[0])
    if not n:
        return np.zeros(0, bool), np.zeros(0, bool), last
    new = np.append(True, np.any([k[1:] != k[:-1] for k in keys], axis=0))
    on = last is not None and last[0] == tuple(k[0] for k in keys)
    new[0] = not on
    head = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    firsts = [p[head] for p in places]
    if on:
        own = np.cumsum(new) == 0
        firsts = [np.where(own, v, f) for v, f in zip(last[1], firsts, strict=True)]
    again = ~new & np.any([p != f for p, f in zip(places, firsts, strict=True)], axis=0)
    return new, again, (tuple(k[-1] for k in keys), tuple(f[-1] for f in firsts))


def _run_batches(length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, sigs = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for chunk in chunks(batch.column(2)):
                own, first, count, h, ctx = runs(chunk, length, gram)
                doc, sig = docs[chunk.first + own], sigs[chunk.first + own]
                pos = first - chunk.starts[own]
                order = np.lexsort((pos, sig, doc, ctx, h))
                doc, sig, pos, count, h, ctx = (x[order] for x in (doc, sig, pos, count, h, ctx))
                fresh, again, _ = _repeats([h, ctx], [doc, sig, pos])
                sure = _merged(doc[again], sig[again], pos[again], count[again] + length - 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate((h[fresh], _dealt(*sure))).view(np.int64)),
                     pa.array(np.concatenate((ctx[fresh].view(np.int64), np.zeros(len(sure[0]), np.int64)))),
                     *[pa.array(np.concatenate((x[fresh], y))) for x, y in zip((doc, sig, pos), sure[:3], strict=True)],
                     pa.array(np.concatenate((count[fresh], -sure[3])).astype(np.int32))],
                    names=["h", "ctx", "doc", "sig", "pos", "n"])

    return run


def _dealt(doc: np.ndarray, sig: np.ndarray, pos: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Numbers that deal settled spans over all tasks."""
    return mixed(doc.astype(np.uint64) + sig.astype(np.uint64) + pos.astype(np.uint64))


def _mark_batches(length: int):
    """Rows sorted by anchor, context and place: repeats to remove, and first contexts that others may repeat."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last first context, with whether its anchor had another before it
        last = None
        for batch in batches:
            h, ctx, doc, sig, pos, n = (batch.column(c).to_numpy() for c in range(6))
            sure = n < 0
            spans = [(doc[sure], sig[sure], pos[sure], -n[sure].astype(np.int64))]
            h, ctx, doc, sig, pos, n = (x[~sure] for x in (h, ctx, doc, sig, pos, n))
            need = []
            if len(h):
                first, again, last = _repeats([h, ctx], [doc, sig, pos], last)
                spans.append((doc[again], sig[again], pos[again], n[again].astype(np.int64) + length - 1))
                fresh = np.stack([x[first].astype(np.int64) for x in (h, doc, sig, pos, n)], axis=1)
                if held is not None:
                    fresh = np.concatenate((held[0], fresh))
                if len(fresh):
                    near = fresh[1:, 0] == fresh[:-1, 0]
                    many = np.append(near, False) | np.append(False, near)
                    if held is not None:
                        many[0] |= held[1]
                    need = [fresh[:-1][many[:-1]]]
                    held = (fresh[-1:], bool(many[-1]))
            yield _marks(need, spans)
        if held is not None and held[1]:
            yield _marks([held[0]], [])

    return run


def _marks(need: list[np.ndarray], spans: list[tuple]) -> pa.RecordBatch:
    rows = np.concatenate([np.zeros((0, 5), np.int64), *need])
    cut = [np.concatenate([np.zeros(0, np.int64), *(s[k] for s in spans)]) for k in range(4)]
    cut = _merged(*cut)
    flags = np.append(np.ones(len(rows), bool), np.zeros(len(cut[0]), bool))
    return pa.RecordBatch.from_arrays(
        [pa.array(flags), pa.array(np.append(rows[:, 0], np.zeros(len(cut[0]), np.int64))),
         *[pa.array(np.append(rows[:, k + 1], cut[k])) for k in range(3)],
         pa.array(np.append(rows[:, 4], cut[3]).astype(np.int32))], names=["need", "h", "doc", "sig", "pos", "n"])


def _context_batches(length: int):
    """The bytes of the contexts that a document was asked for; of hot anchors, the hash of each window instead."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hot, held = [], 0
            for k in range(batch.num_rows):
                doc, sig = (batch.column(c)[k].as_py() for c in (0, 1))
                text = batch.column(2)[k].as_buffer()
                asked = batch.column(3)[k].values
                h, pos, n, is_hot = (asked.field(c).to_numpy(zero_copy_only=False) for c in range(4))
                if is_hot.any():
                    chunk = Chunk(0, np.frombuffer(text, np.uint8), np.array([0, len(text)]))
                    count = n[is_hot].astype(np.int64)
                    step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                    at = np.repeat(pos[is_hot], count) + step
                    hot.append((np.repeat(h[is_hot], count), chunk.hashes(at, at + length).view(np.int64),
                                np.full(len(at), doc), np.full(len(at), sig), at))
                    held += len(at)
                    if held >= HOT_WINDOWS:
                        yield _settled_windows(hot, length)
                        hot, held = [], 0
                h, pos, n = h[~is_hot], pos[~is_hot], n[~is_hot]
                if not len(h):
                    continue
                data = memoryview(text) if text is not None else memoryview(b"")
                cut = [data[s:s + m + length - 1].tobytes() for s, m in zip(pos.tolist(), n.tolist(), strict=True)]
                yield _contexts(h, np.zeros(len(h), np.int64), np.full(len(h), doc), np.full(len(h), sig), pos, n,
                                pa.array(cut, pa.binary()))
            if hot:
                yield _settled_windows(hot, length)

    return run


def _contexts(h, window, doc, sig, pos, n, data: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [*[pa.array(x) for x in (h, window, doc, sig, pos)], pa.array(n.astype(np.int32)), data],
        names=["h", "window", "doc", "sig", "pos", "n", "bytes"])


def _settled_windows(parts: list[tuple], length: int) -> pa.RecordBatch:
    """The first of each window of hot anchors, and the spans of those that repeat it (``n`` below 0)."""
    h, window, doc, sig, pos = (np.concatenate(c) for c in zip(*parts, strict=True))
    order = np.lexsort((pos, sig, doc, window, h))
    h, window, doc, sig, pos = (x[order] for x in (h, window, doc, sig, pos))
    first, again, _ = _repeats([h, window], [doc, sig, pos])
    sure = _merged(doc[again], sig[again], pos[again], np.full(int(again.sum()), length))
    return _contexts(np.append(h[first], _dealt(*sure).view(np.int64)),
                     np.append(window[first], np.zeros(len(sure[0]), np.int64)),
                     *[np.append(x[first], y) for x, y in zip((doc, sig, pos), sure[:3], strict=True)],
                     np.append(np.ones(int(first.sum()), np.int64), -sure[3]),
                     pa.nulls(int(first.sum()) + len(sure[0]), pa.binary()))


def repeated_windows(contexts: list[bytes], length: int, rank: np.ndarray, count: np.ndarray
                     ) -> tuple[np.ndarray, np.ndarray]:
    """(context, window) of every window that equals one of an earlier place.

    ``count[k]`` windows begin in context k, whose first window is at place ``rank[k]`` = (document, its hash, position).
    """
    sizes = np.array([len(c) for c in contexts])
    starts = np.concatenate(([0], np.cumsum(sizes + 1)))[:-1]
    text = np.ones(int(sizes.sum()) + len(sizes) + 1, np.int16)  # 1 parts contexts, 0 ends all
    inside = np.ones(len(text), bool)
    inside[starts + sizes] = False
    inside[-1] = False
    text[inside] = np.frombuffer(b"".join(contexts), np.uint8).astype(np.int16) + 2
    text[-1] = 0
    present = np.unique(text)
    code = np.zeros(int(present[-1]) + 1, np.int16)
    code[present] = np.arange(len(present))
    text = code[text]
    order = suffix_array(text, len(present))
    shared = common_prefixes(text, order, 1)
    group = np.cumsum(shared[order] < length)
    owner = np.repeat(np.arange(len(sizes)), sizes + 1)
    owner = np.append(owner, len(sizes))
    window = np.arange(len(text)) - np.append(starts, len(text) - 1)[owner]
    starting = window < np.append(count, 0)[owner]
    use = starting[order]
    at, group = order[use], group[use]
    k, w = owner[at], window[at]
    by = np.lexsort((rank[k, 2] + w, rank[k, 1], rank[k, 0], group))
    later = np.append(False, group[by][1:] == group[by][:-1])[:len(by)]
    # a window met twice at one place is one window
    place = np.stack((rank[k, 0], rank[k, 1], rank[k, 2] + w), axis=1)[by]
    head = np.maximum.accumulate(np.where(later, 0, np.arange(len(by))))
    later &= (place != place[head]).any(axis=1)
    return k[by][later], w[by][later]


def _shard_batches(length: int, shard_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[list] = [[], [], [], [], [], []]
        held, cut = 0, 0  # bytes held; rows of whole anchors
        last = None  # the last window of a hot anchor, with its first place

        def settle(upto: int) -> pa.RecordBatch:
            part = [c[:upto] for c in rows]
            for c in rows:
                del c[:upto]
            rank = np.array([part[1], part[2], part[3]], np.int64).T
            k, w = repeated_windows(part[5], length, rank, np.array(part[4]))
            return _marks([], [(rank[k, 0], rank[k, 1], rank[k, 2] + w, np.full(len(k), length))])

        for batch in batches:
            hot = batch.filter(pc.is_null(batch.column(6)))
            if hot.num_rows:
                h, window, doc, sig, pos, n = (hot.column(c).to_numpy() for c in range(6))
                sure = n < 0
                spans = [(doc[sure], sig[sure], pos[sure], -n[sure].astype(np.int64))]
                h, window, doc, sig, pos = (x[~sure] for x in (h, window, doc, sig, pos))
                _, again, last = _repeats([h, window], [doc, sig, pos], last)
                spans.append((doc[again], sig[again], pos[again], np.full(int(again.sum()), length)))
                yield _marks([], spans)
            batch = batch.filter(pc.is_valid(batch.column(6))).select(["h", "doc", "sig", "pos", "n", "bytes"])
            for part in (batch.slice(n, 2000) for n in range(0, batch.num_rows, 2000)):
                values = [c.to_pylist() for c in part.columns]
                for k in range(part.num_rows):
                    if rows[0] and values[0][k] != rows[0][-1]:
                        cut = len(rows[0])
                        if held >= shard_bytes:
                            yield settle(cut)
                            held = 0
                    for c in range(6):
                        rows[c].append(values[c][k])
                    held += len(values[5][k])
        if rows[0]:
            yield settle(len(rows[0]))

    return run


def _cut_batches(key: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, gone, spans, kept, sums = [], [], [], [], []
            for k in range(batch.num_rows):
                text = batch.column(1)[k].as_buffer()
                data = text.to_pybytes() if text is not None else b""
                cut = batch.column(2)[k].values
                parts, at, removed, n = [], 0, 0, 0
                if cut is not None and len(cut):
                    pos, one = cut.field(0).to_numpy(), np.zeros(len(cut), np.int64)
                    _, _, begin, length = _merged(one, one, pos, cut.field(1).to_numpy().astype(np.int64))
                    for a, m in zip(begin.tolist(), length.tolist(), strict=True):
                        parts.append(data[at:a])
                        at, removed, n = a + m, removed + m, n + 1
                parts.append(data[at:])
                left = b"".join(parts)
                size.append(len(data))
                gone.append(removed)
                spans.append(n)
                kept.append(left)
                sums.append(hashlib.sha256(left).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(size, pa.int64()), pa.array(gone, pa.int64()), pa.array(spans, pa.int64()),
                 pa.array(kept, pa.binary()), pa.array(sums, pa.string())],
                names=[key, "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"])

    return run


def deduplicated(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM,
                 shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``key``, n_bytes, n_removed, n_spans, kept (the bytes left) and kept_sha256 of every document."""
    k, t = F.col(f"`{key}`"), F.col(f"`{text}`").cast("binary")
    texts = docs.select(F.coalesce(k.cast("long"), F.lit(_LAST)).alias("doc"),
                        F.xxhash64(t, k).alias("sig"), t.alias("text"), k.alias("key"))
    found = texts.select("doc", "sig", "text").mapInArrow(_run_batches(length, gram), ROW)
    marks = found.repartition("h").sortWithinPartitions("h", "ctx", "doc", "sig", "pos").mapInArrow(
        _mark_batches(length), MARK)
    marks = written(marks, "marks")
    need = marks.where("need").select("h", "doc", "sig", "pos", "n")
    hot = written(need.groupBy("h").agg(F.sum(F.col("n").cast("long") + F.lit(length - 1)).alias("size")).where(
        F.col("size") > shard_bytes).select("h", F.lit(True).alias("hot")), "hot")
    asked = need.join(hot, "h", "left").groupBy("doc", "sig").agg(F.collect_list(F.struct(
        "h", "pos", "n", F.coalesce("hot", F.lit(False)).alias("hot"))).alias("asked"))
    contexts = texts.dropDuplicates(["doc", "sig"]).join(asked, ["doc", "sig"]).select("doc", "sig", "text", "asked") \
        .mapInArrow(_context_batches(length), "h long, window long, doc long, sig long, pos long, n int, bytes binary")
    repeats = contexts.repartition("h", "window").sortWithinPartitions("h", "window", "doc", "sig", "pos").mapInArrow(
        _shard_batches(length, shard_bytes), MARK)
    spans = marks.where("NOT need").unionByName(repeats).select("doc", "sig", "pos", "n")
    cuts = spans.groupBy("doc", "sig").agg(F.collect_list(F.struct("pos", "n")).alias("cuts"))
    kind = texts.schema["key"].dataType.simpleString()
    return texts.join(cuts, ["doc", "sig"], "left").select("key", "text", "cuts").mapInArrow(
        _cut_batches(key), f"`{key}` {kind}, n_bytes long, n_removed long, n_spans long, kept binary, "
                           "kept_sha256 string")

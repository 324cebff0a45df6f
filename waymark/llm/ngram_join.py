"""N-gram Jaccard join: an inverted index skipped by position, with answers derived from computed ones.

Documents are sets of five-word shingles; equal sets are one class, so copies cost nothing beyond the first. A class is
indexed under its rarest shingles, as many as one must share with any set of similarity 0.8. Which shingles are common
is a fixed-size bitmap, filled where a task meets a shingle in a second set; it only orders shingles, so
results don't depend on it. Each index list is ordered by set size and holds the position of its shingle in each set:

* Skipping by position: size and position of two members bound what their sets can still share; members that can't
  reach the threshold are no pair. A list is ordered by size, so a member only meets the stretch of sizes in reach.
* Answers from answers: each list has a leader, its smallest set, against which all its members are verified, once for
  all lists. Members linked to a common leader are one component and need no test among each other. For others the
  leader's answers bound theirs: two sets share at most what both share with the leader plus what both have besides,
  and at least what the leader's answers force.

* Sketches: a bit for each place says whether a set has an odd number of shingles there, so two sets differ by at least as
  many shingles as their sketches do by bits. That settles pairs that met by chance, of which there are more than in
  proportion to the input, without their sets: a leader's whole set only meets those of the members that its sketch
  leaves open, and only such pairs of a list are open.

Pairs that these bounds leave open are never written one by one: of a list's graph of open pairs, only a spanning forest
is, which is fewer rows than the list has members. Classes joined by open pairs of any lists form a cluster, in which
all open pairs lie. A cluster is cut by size into blocks; two blocks whose sizes are in reach meet in one task, which
counts what whole sets share by an index of their shingles and gives out the links that join components, again a forest.

So a group of near copies writes rows in proportion to its members, though members linked to no common leader are still
compared with each other inside tasks. What is left of lists longer than ``BLOCK`` is paired in parts by a hash of the
signature; these parts have no bounds of their own, so none is skipped whole. Verification compares whole sets of
64-bit hashes; sets are written for the classes of pairs to verify alone, first for leaders, then for clusters, and
deleted after. Components come from label rounds.

Defined results: null and empty texts, and texts without words, have no set and are linked with nothing; fewer words
than five are one shingle; rows with a null key take part and come last in the order; rows with equal keys are linked
as any others. A component is named by its smallest key. An empty table gives an empty result. Other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.llm.tables import freed_shuffles, scratch, small_batches, written
from waymark.llm.text import Chunk, chunks, mixed, owners, shingles

WORDS = 5
#: Similarity, as a fraction of whole numbers.
NUMERATOR, DENOMINATOR = 4, 5
BLOCK = 4096
SALTS = 64
COMMON_BITS = 26
BITS = 23
SEEN_BITS = 27
OFTEN = 2
#: Bits of a sketch, at most; it has as many as the set has shingles, or up to twice as many.
SKETCH_BITS = 1 << 13
#: Classes of a cluster that meet those of another block, or each other, in one task.
CLUSTER_BLOCK = 1024
SETS_PER_BATCH = 500
TEXTS_PER_BATCH = 1000
_LAST = (1 << 63) - 1


def prefix_length(n):
    """How many of n shingles must be indexed so that similar sets meet."""
    return n - (NUMERATOR * n + DENOMINATOR - 1) // DENOMINATOR + 1


def shared_at_least(n, m):
    """The least intersection of linked sets of n and m shingles."""
    return -(-NUMERATOR * (n + m) // (NUMERATOR + DENOMINATOR))


def sets_of(chunk: Chunk, size: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each document, in order, and where each document's begin."""
    chunk.lowered()
    begin, end, bounds = chunk.words()
    words = chunk.hashes(begin, end)
    run, at = shingles(words, bounds, size)
    own = owners(bounds)[at] if len(at) else np.zeros(0, np.int64)
    count = np.diff(bounds)
    few = np.flatnonzero((count > 0) & (count < size))
    whole = np.zeros(len(few), np.uint64)
    for k in range(size - 1):
        live = count[few] > k
        whole[live] = mixed(whole[live] * np.uint64(0xD6E8FEB86659FD93) + words[bounds[few[live]] + k] + np.uint64(1))
    size_of = np.bincount(own, minlength=chunk.n)
    size_of[few] = 1
    edge = np.concatenate(([0], np.cumsum(size_of)))
    out = np.zeros(edge[-1], np.uint64)
    single = np.zeros(edge[-1], bool)
    single[edge[few]] = True
    out[~single], out[single] = run, whole
    for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
        out[a:b].sort()  # plain sorts of slices, several times as fast as one sort by two keys
    new = np.ones(len(out), bool)
    new[1:] = out[1:] != out[:-1]
    new[edge[:-1][size_of > 0]] = True
    return out[new], np.concatenate(([0], np.cumsum(new)))[edge]


def signatures(run: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A hash of each set; 0 for none."""
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mixed(run + np.uint64(7)))))
    n = np.diff(bounds)
    return np.where(n > 0, mixed(total[bounds[1:]] - total[bounds[:-1]] + n.astype(np.uint64)), np.uint64(0))


def sketches(run: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    """Of each set, which places an odd number of its shingles falls on."""
    bits = np.clip(1 << np.ceil(np.log2(np.maximum(np.diff(bounds), 1))).astype(np.int64), 64, SKETCH_BITS)
    edge, own = np.concatenate(([0], np.cumsum(bits))), owners(bounds)
    place = edge[own] + (run & (bits[own] - 1).astype(np.uint64)).astype(np.int64)
    packed = np.packbits(np.bincount(place, minlength=edge[-1]) & 1 > 0, bitorder="little")
    return [packed[a:b].tobytes() for a, b in zip((edge[:-1] // 8).tolist(), (edge[1:] // 8).tolist(), strict=True)]


def most_shared(n, m, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """What sets of n and m shingles share at most, by their sketches, arrays of 64-bit numbers, of which y may be rows."""
    while x.shape[-1] != y.shape[-1]:  # the longer one's halves fall on the same places in the shorter one
        if x.shape[-1] > y.shape[-1]:
            x = x[..., :x.shape[-1] // 2] ^ x[..., x.shape[-1] // 2:]
        else:
            y = y[..., :y.shape[-1] // 2] ^ y[..., y.shape[-1] // 2:]
    return (n + m - np.bitwise_count(x ^ y).sum(axis=-1, dtype=np.int64)) // 2


def _class_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Key, size and signature of each document, and a sketch of each set once a chunk; and rows of size -1 with bitmap
    positions of common shingles."""
    seen = np.zeros(1 << SEEN_BITS - 3, np.uint8)
    names = ["doc", "text_hash", "n", "sig", "sketch"]

    def common(run):
        """Shingles of this chunk's different sets that two of them hold, or one of an earlier chunk."""
        value, count = np.unique(run, return_counts=True)
        at = (value >> np.uint64(64 - SEEN_BITS)).astype(np.int64)
        place, bit = at >> 3, np.uint8(1) << (at & 7).astype(np.uint8)
        again = (count >= OFTEN) | ((seen[place] & bit) != 0)
        np.bitwise_or.at(seen, place, bit)
        bit = np.unique(value[again] >> np.uint64(64 - COMMON_BITS)).astype(np.int64)
        zero = pa.array(np.zeros(len(bit), np.int64))
        return pa.RecordBatch.from_arrays([zero, zero, pa.array(np.full(len(bit), -1)), pa.array(bit),
                                           pa.nulls(len(bit), pa.binary())], names=names)

    for batch in batches:
        for chunk in chunks(batch.column(1)):
            run, bounds = sets_of(chunk)
            doc, text_hash = (batch.column(c).slice(chunk.first, chunk.n) for c in (0, 2))
            sig, n = signatures(run, bounds), np.diff(bounds)
            first = np.zeros(chunk.n, bool)
            first[_first_of_class(sig)] = True
            run = run[first[owners(bounds)]]
            sketch = np.full(chunk.n, None, object)
            sketch[first] = np.array([*sketches(run, np.concatenate(([0], np.cumsum(n[first])))), None], object)[:-1]
            sketch[n == 0] = None
            yield pa.RecordBatch.from_arrays([doc, text_hash, pa.array(n), pa.array(sig.view(np.int64)),
                                              pa.array(sketch, pa.binary())], names=names)
            yield common(run)


def _bitmap(positions: DataFrame, column: str, n_bits: int = BITS) -> np.ndarray:
    """A bit for each position below 2 ** n_bits, of fixed size whatever the input."""
    place = F.col(column) + 1  # Spark counts bits from 1
    rows = positions.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")).collect()  # 2 ** n_bits bits at most
    out = np.zeros(1 << n_bits, bool)
    for bucket, bits in rows:
        own = np.unpackbits(np.frombuffer(bytes(bits), np.uint8), bitorder="little")
        start = (bucket - 1) * 32768
        out[start:start + 32768] = own[:max(0, min(32768, len(out) - start))]
    return np.packbits(out)


def _on(bitmap: np.ndarray, values: np.ndarray) -> np.ndarray:
    at = (values >> np.uint64(64 - (8 * len(bitmap) - 1).bit_length())).astype(np.int64)
    return (bitmap[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 > 0


def _first_of_class(sig: np.ndarray) -> np.ndarray:
    return np.sort(np.unique(sig, return_index=True)[1])


def _rare_first(often: np.ndarray, bounds: np.ndarray, own: np.ndarray) -> np.ndarray:
    """The place of each hash in its set when those not ``often`` met come first, both kinds in order of hash."""
    rare = np.concatenate(([0], np.cumsum(~often)))
    before = rare[:-1] - rare[bounds[own]]
    within = np.arange(len(own)) - bounds[own]
    total = (rare[bounds[1:]] - rare[bounds[:-1]])[own]
    return np.where(often, total + within - before, before)


def _posting_batches(common: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column(0)):
                hashes, bounds = sets_of(chunk)
                sig, n = signatures(hashes, bounds), np.diff(bounds)
                own = owners(bounds)
                pos = _rare_first(_on(common, hashes), bounds, own)
                take = np.zeros(chunk.n, bool)
                take[_first_of_class(sig)] = True
                use = take[own] & (pos < prefix_length(n[own]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hashes[use].view(np.int64)), pa.array(sig[own[use]].view(np.int64)),
                     pa.array(n[own[use]].astype(np.int32)), pa.array(pos[use].astype(np.int32))],
                    names=["token", "sig", "n", "pos"])

    return run


LIST = "token long, total long, lead long, lead_n int, lead_pos int, sigs array<long>, ns array<int>, poss array<int>"


def _list_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Index lists of two classes or more, in rows of at most BLOCK members; ``total`` counts members so far."""
    held, before, lead = None, 0, None  # rows of an open list; members given out before them; its leader

    def rows(columns, closed):
        nonlocal before, lead
        token, sig, n, pos = columns
        edge = np.flatnonzero(np.append(True, token[1:] != token[:-1]))
        ends = np.append(edge[1:], len(token))
        if not closed:
            edge, ends = edge[:-1], ends[:-1]
        out = [[] for _ in range(8)]
        for k, (a, b) in enumerate(zip(edge.tolist(), ends.tolist(), strict=True)):
            first = lead if k == 0 and before else (int(sig[a]), int(n[a]), int(pos[a]))
            base = before if k == 0 else 0
            if b - a + base > 1:
                for i, value in enumerate((int(token[a]), b - a + base, *first, sig[a:b], n[a:b], pos[a:b])):
                    out[i].append(value)
        if closed or len(edge):
            before, lead = 0, None
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), *(pa.list_(t) for t in (
            pa.int64(), pa.int32(), pa.int32())))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)],
                                          names=[f.split(" ")[0] for f in LIST.split(", ")])

    def single(columns):
        """Without classes that a list names twice, and without lists of one."""
        token, sig, n, pos = columns
        new = np.append(True, (token[1:] != token[:-1]) | (sig[1:] != sig[:-1]))[:len(token)]
        return [c[new] for c in columns]

    for batch in batches:
        columns = [c.to_numpy() for c in batch.columns]
        if held is not None:
            columns = [np.concatenate((a, b)) for a, b in zip(held, columns, strict=True)]
        if not len(columns[0]):
            continue
        columns = single(columns)
        last = int(np.searchsorted(columns[0], columns[0][-1]))
        head, held = [c[:last] for c in columns], [c[last:] for c in columns]
        if last:
            token = head[0]
            edge = np.append(True, token[1:] != token[:-1])
            alone = edge & np.append(edge[1:], True)
            if before:
                alone[0] = False
            keep = [c[~alone] for c in head]
            if len(keep[0]):
                yield rows(keep, True)
            before, lead = 0, None
        while len(held[0]) > BLOCK:
            part, held = [c[:BLOCK] for c in held], [c[BLOCK:] for c in held]
            first = lead or tuple(int(c[0]) for c in part[1:])
            done = before + BLOCK
            yield rows(part, True)
            before, lead = done, first
    if held is not None and len(held[0]):
        yield rows(held, True)


def _set_batches(wanted: np.ndarray):
    """Signature, size and set, as bytes, of classes whose bit is set; one row of each class a chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches if wanted.any() else ():
            for chunk in chunks(batch.column(0)):
                hashes, bounds = sets_of(chunk)
                sig = signatures(hashes, bounds)
                first = _first_of_class(sig)
                first = first[_on(wanted, sig[first]) & (sig[first] != 0)]
                sets = [hashes[bounds[k]:bounds[k + 1]] for k in first]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(sig[first].view(np.int64)), pa.array([len(x) for x in sets], pa.int64()),
                     pa.array([x.tobytes() for x in sets], pa.binary())], names=["sig", "size", "held"])

    return run


def _sketch_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Those pairs a, b (sizes n and m, sketches x and y) that may reach the threshold."""
    for batch in batches:
        n, m = (batch.column(c).to_numpy() for c in (2, 3))
        x, y = ([np.frombuffer(v.as_buffer(), np.uint64) for v in batch.column(c)] for c in (4, 5))
        most = np.array([most_shared(*row) for row in zip(n, m, x, y, strict=True)], np.int64)
        yield batch.select(["a", "b"]).filter(pa.array(most >= shared_at_least(n, m)))


def _verify_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        shared, sizes = [], []
        for k in range(batch.num_rows):
            a = np.frombuffer(batch.column(2)[k].as_buffer(), np.uint64)
            b = np.frombuffer(batch.column(3)[k].as_buffer(), np.uint64)
            place = np.searchsorted(a, b)
            shared.append(int((a[np.minimum(place, len(a) - 1)] == b).sum()))
            sizes.append((len(a), len(b)))
        n, m = np.array(sizes, np.int64).reshape(-1, 2).T
        s = np.array(shared, np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(s), pa.array(s >= shared_at_least(n, m))],
            names=["a", "b", "shared", "linked"])


def _sets(wanted: DataFrame, texts: DataFrame, folder: str) -> DataFrame:
    """``sig`` and the set of the wanted classes, once each, and of a few others."""
    bits = _bitmap(wanted.select(F.shiftrightunsigned("sig", 64 - BITS).alias("bit")), "bit")
    return written(texts.select("text").mapInArrow(_set_batches(bits), "sig long, size long, held binary"), "sets",
                   folder).select("sig", "held").dropDuplicates(["sig"])


def verified(pairs: DataFrame, sketched: DataFrame, texts: DataFrame, folder: str) -> DataFrame:
    """a, b (signatures), shared and linked, from the whole sets, of each pair that the sketches leave open."""
    with scratch(texts.sparkSession, "verify") as inner:
        for side, size, sketch in (("b", "m", "y"), ("a", "n", "x")):
            pairs = pairs.join(sketched.select(F.col("sig").alias(side), F.col("n").alias(size), F.col("sketch").alias(
                sketch)), side)
        pairs = written(pairs.select("a", "b", "n", "m", "x", "y").mapInArrow(_sketch_batches, "a long, b long"), "near",
                        inner)
        own = _sets(pairs.select(F.explode(F.array("a", "b")).alias("sig")), texts, inner)
        for side in ("b", "a"):
            pairs = pairs.join(own.select(F.col("sig").alias(side), F.col("held").alias(f"held_{side}")), side)
        return written(pairs.select("a", "b", "held_a", "held_b").mapInArrow(
            _verify_batches, "a long, b long, shared long, linked boolean"), "answers", folder)


def components(links: DataFrame, name: str = "labels", folder: str | None = None) -> DataFrame:
    """node and label, the smallest node reachable, of every node of the links (a, b).

    Each round takes the smallest label of the neighbours and then the label of that label; labels only fall, and
    the rounds end when none does.
    """
    both = written(links.select("a", "b").union(links.select("b", "a")).distinct(), f"{name}-edges", folder)
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select(
        "node", F.least("node", "m").alias("label")), name, folder)
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(
            F.min("label").alias("m"))
        fallen = labels.join(near, "node").select("node", "label", F.least("label", "m").alias("next"))
        jumped = fallen.join(labels.select(F.col("node").alias("next"), F.col("label").alias("far")), "next").select(
            "node", F.least("next", "far").alias("new"), (F.least("next", "far") < F.col("label")).alias("moved"))
        done = written(jumped, name, folder)
        moved = done.where("moved").limit(1).count()
        labels = done.select("node", F.col("new").alias("label"))
        if not moved:
            return labels


def merged(labels: DataFrame, links: DataFrame, name: str, folder: str) -> DataFrame:
    """The labels once the links (a, b) are added: the links join labels, so only those go through new rounds."""
    for side in ("a", "b"):
        links = links.join(labels.select(F.col("node").alias(side), F.col("label").alias(f"label_{side}")), side,
                           "left")
    placed = written(links.select("a", "b", F.coalesce("label_a", "a").alias("x"), F.coalesce("label_b", "b").alias(
        "y")), f"{name}-placed", folder)
    higher = components(placed.where("x != y").select(F.col("x").alias("a"), F.col("y").alias("b")), name, folder)
    own = placed.select(F.explode(F.array(F.struct(F.col("a").alias("node"), F.col("x").alias("label")), F.struct(
        F.col("b").alias("node"), F.col("y").alias("label")))).alias("s")).select("s.node", "s.label")
    return written(labels.union(own).distinct().join(higher.select(F.col("node").alias("label"), F.col("label").alias(
        "top")), "label", "left").select("node", F.coalesce("top", "label").alias("label")), f"{name}-all", folder)


def _joined(lab: np.ndarray, i: int, at: np.ndarray, into: int) -> np.ndarray:
    """One member of ``at`` for each group of ``lab`` that is not i's; these groups and i's become ``into``."""
    near, first = np.unique(lab[at], return_index=True)
    new = near != lab[i]
    out = at[first[new]]
    if len(out):
        lab[np.isin(lab, near) | (lab == lab[i])] = into
    return out


def _open_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spanning forests of two graphs of a list: the pairs of members in different components that neither position nor
    the leader's answers settle, and those that the answers force.

    Rows come sorted by list part; of a part that joins two blocks, only pairs across them are wanted. A last column, if
    there, holds sketches, which settle more pairs.
    """
    held = None

    def near(i, at, n, tables):
        """Those of ``at`` that may reach the threshold with i, by the sketches of each length and the rows in them."""
        size, row, table = tables
        out = []
        for k in np.unique(size[at]).tolist():
            own = at[size[at] == k]
            out.append(own[most_shared(n[i], n[own], table[size[i]][row[i]], table[k][row[own]]) >= shared_at_least(
                n[i], n[own])])
        return np.sort(np.concatenate(out))

    def by_length(sketch):
        size, row, table = np.array([len(x) for x in sketch]), np.zeros(len(sketch), np.int64), {}
        for k in np.unique(size).tolist():
            at = np.flatnonzero(size == k)
            row[at] = np.arange(len(at))
            table[k] = np.frombuffer(b"".join(sketch[at]), np.uint64).reshape(len(at), k // 8)
        return size, row, table

    def pairs(columns):
        key = columns[0]
        edge = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        a_out, b_out, forced_out = [], [], []
        for lo, hi in zip(edge, np.append(edge[1:], len(key)), strict=True):
            _, side, single, sig, n, pos, comp, with_lead, lead_n = (c[lo:hi] for c in columns[:9])
            order = np.argsort(n, kind="stable")
            sketch, tables = columns[9][lo:hi][order] if len(columns) > 9 else None, None
            side, sig, n, pos, comp, with_lead = (c[order] for c in (side, sig, n, pos, comp, with_lead))
            last = np.searchsorted(n, n * DENOMINATOR // NUMERATOR, "right")
            groups = np.arange(len(n)), np.arange(len(n))  # by forced pairs and by open ones
            for i in range(len(n)):
                j = slice(i + 1, last[i])
                least = shared_at_least(n[i], n[j])
                use = (comp[j] != comp[i]) & (np.minimum(n[i] - pos[i], n[j] - pos[j]) >= least)
                if not single[0]:
                    use &= side[j] != side[i]
                forced = np.zeros(len(use), bool)
                if with_lead[i] >= 0:
                    known = with_lead[j]
                    most = np.minimum(with_lead[i], known) + np.minimum(n[i] - with_lead[i], n[j] - known)
                    use &= (known < 0) | (most >= least)
                    forced = (known >= 0) & (with_lead[i] + known - lead_n[0] >= least)
                for lab, sure, ok in zip(groups, (True, False), (use & forced, use & ~forced), strict=True):
                    at = i + 1 + np.flatnonzero(ok)
                    if not sure and sketch is not None:
                        at = at[lab[at] != lab[i]]
                        if len(at):
                            tables = tables or by_length(sketch)
                            at = near(i, at, n, tables)
                    at = _joined(lab, i, at, lab[i]) if len(at) else ()
                    if len(at):
                        a_out.append(np.minimum(sig[at], sig[i]))
                        b_out.append(np.maximum(sig[at], sig[i]))
                        forced_out.append(np.full(len(at), sure))
        none = np.zeros(0, np.int64)
        a, b = np.concatenate((none, *a_out)), np.concatenate((none, *b_out))
        forced = np.concatenate((np.zeros(0, bool), *forced_out))
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(forced)], names=["a", "b", "forced"])

    for batch in batches:
        columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if held is not None:
            columns = [np.concatenate(x) for x in zip(held, columns, strict=True)]
        if not len(columns[0]):
            continue
        last = int(np.flatnonzero(columns[0] != columns[0][-1]).max(initial=-1)) + 1
        held = [c[last:] for c in columns]
        if last:
            yield pairs([c[:last] for c in columns])
    if held is not None:
        yield pairs(held)


def _link_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links, a spanning forest, that join the components of each part's classes.

    Rows are part, side, sig, comp and set, sorted by part; of a part that joins two blocks, only pairs across them count.
    """

    def links(rows):
        side, sig, comp = (np.concatenate([r.column(c).to_numpy() for r in rows]) for c in (1, 2, 3))
        value, lab, count = np.unique(comp, return_inverse=True, return_counts=True)
        if len(value) == 1:
            return []
        sets = [np.frombuffer(v.as_buffer(), np.uint64) for r in rows for v in r.column(4)]
        n = np.array([len(x) for x in sets], np.int64)
        # an index: of each shingle, the members that hold it
        bounds = np.concatenate(([0], np.cumsum(n)))
        token = np.unique(np.concatenate(sets), return_inverse=True)[1]
        holder = owners(bounds)[np.argsort(token, kind="stable")]
        begin = np.concatenate(([0], np.cumsum(np.bincount(token))))
        # each pair across components has a side that is outside the largest one, or was when its turn came
        most = int(count.argmax())
        apart = side[0] != side[-1]
        out = []
        for i in np.flatnonzero(lab != most).tolist():
            wanted = lab != lab[i]
            if apart:
                wanted &= side != side[i]
            if lab[i] == most or not wanted.any():
                continue
            own = token[bounds[i]:bounds[i + 1]]
            size = begin[own + 1] - begin[own]
            own, size = own[size > 1], size[size > 1]
            place = np.repeat(begin[own] - np.cumsum(size) + size, size) + np.arange(size.sum())
            shared = np.bincount(holder[place], minlength=len(n))
            at = np.flatnonzero(wanted & (shared >= shared_at_least(n[i], n)))
            if len(at):
                joined = _joined(lab, i, at, most if (lab[at] == most).any() else int(lab[i]))
                out += [(min(sig[i], sig[k]), max(sig[i], sig[k])) for k in joined]
        return out

    def table(out):
        a, b = np.array(out, np.int64).reshape(-1, 2).T
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    held = []
    for batch in batches:
        part, out = batch.column(0).to_numpy(), []
        edge = np.append(np.flatnonzero(np.append(True, part[1:] != part[:-1])[:len(part)]), len(part)).tolist()
        for lo, hi in zip(edge[:-1], edge[1:], strict=True):
            if held and held[-1].column(0)[0].as_py() != part[lo]:
                out += links(held)
                held = []
            held.append(batch.slice(lo, hi - lo))
        yield table(out)
    if held:
        yield table(links(held))


def cluster_links(clusters: DataFrame, labels: DataFrame, sketched: DataFrame, texts: DataFrame, folder: str) -> DataFrame:
    """a, b: links that join the labels of classes in one cluster (node, label), as few as a task needs."""
    nodes = clusters.select(F.col("node").alias("sig"), F.col("label").alias("cluster"))
    comps = labels.select(F.col("node").alias("sig"), F.col("label").alias("comp"))
    with scratch(texts.sparkSession, "clustered") as inner:
        placed = written(nodes.join(sketched.select("sig", F.col("n").alias("size")), "sig").join(comps, "sig", "left").select(
            "sig", "cluster", F.coalesce("comp", "sig").alias("comp"), "size",
            F.expr(f"CAST(row_number() OVER (PARTITION BY cluster ORDER BY size, sig) - 1 AS LONG) DIV {CLUSTER_BLOCK}").alias(
                "block")), "placed", inner)
        spans = placed.groupBy("cluster", "block").agg(F.min("size").alias("low"), F.max("size").alias("high"))
        meet = spans.alias("s").join(spans.alias("t"), F.expr(
            f"s.cluster = t.cluster AND s.block <= t.block AND {NUMERATOR} * t.low <= {DENOMINATOR} * s.high")).select(
            "s.cluster", F.xxhash64("s.cluster", "s.block", "t.block").alias("part"), F.explode(F.array_distinct(
                F.array("s.block", "t.block"))).alias("block"))
        rows = placed.join(meet, ["cluster", "block"]).join(_sets(nodes, texts, inner), "sig").select(
            "part", F.col("block").alias("side"), "sig", "comp", "held")
        return written(rows.repartition("part").sortWithinPartitions("part", "side").mapInArrow(
            _link_batches, "a long, b long"), "links", folder)


def labels_of(texts: DataFrame, common: np.ndarray, sketched: DataFrame) -> DataFrame:
    """node and label, the smallest linked class, of every class that has links; ``sketched`` has sig, n and sketch."""
    with scratch(texts.sparkSession, "labels-of") as folder:
        return written(_labels_of(texts, common, sketched, folder), "labels")


def _labels_of(texts: DataFrame, common: np.ndarray, sketched: DataFrame, folder: str) -> DataFrame:
    postings = texts.select("text").mapInArrow(_posting_batches(common), "token long, sig long, n int, pos int")
    lists = written(postings.repartition("token").sortWithinPartitions("token", "n", "sig").mapInArrow(
        _list_batches, LIST), "lists", folder)
    members = lists.select("token", "lead", "lead_n", "lead_pos", F.explode(F.arrays_zip("sigs", "ns", "poss")).alias(
        "m")).select("token", "lead", "lead_n", "lead_pos", F.col("m.sigs").alias("sig"), F.col("m.ns").alias("n"),
                     F.col("m.poss").alias("pos"))
    least = F.ceil(NUMERATOR * (F.col("n") + F.col("lead_n")) / (NUMERATOR + DENOMINATOR))
    close = F.least(F.col("n") - F.col("pos"), F.col("lead_n") - F.col("lead_pos")) >= least
    pairs = written(members.where(close & (F.col("sig") != F.col("lead"))).select(
        F.col("lead").alias("a"), F.col("sig").alias("b")).distinct(), "led", folder)
    sketched = written(sketched.dropDuplicates(["sig"]), "sketches", folder)
    answers = verified(pairs, sketched, texts, folder)
    labels = components(answers.where("linked"), "led-labels", folder)
    # lists of two are settled; of others, those whose members are in more than one component are left
    totals = lists.groupBy("token").agg(F.max("total").alias("total")).where("total > 2")
    left = members.join(totals, "token").join(labels.withColumnRenamed("node", "sig"), "sig", "left").withColumn(
        "comp", F.coalesce("label", "sig"))
    mixed_up = written(left.groupBy("token").agg(F.min("comp").alias("x"), F.max("comp").alias("y"),
                                                 F.max("total").alias("total")).where("x != y").select("token"),
                       "mixed", folder)
    known = answers.select(F.col("a").alias("lead"), F.col("b").alias("sig"), "shared")
    parts = F.ceil(F.col("total") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("sig"), parts).cast("int")
    rows = left.join(mixed_up, "token", "left_semi").join(known, ["lead", "sig"], "left").withColumns(
        {"parts": parts, "own": own}).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    rows = rows.join(sketched.select("sig", "sketch"), "sig").select(
        F.xxhash64("token", F.least("own", "other"), F.greatest("own", "other")).alias("part"),
        F.col("own").cast("long").alias("side"),
        (F.col("parts") == 1).alias("single"), "sig", F.col("n").cast("long").alias("n"),
        F.col("pos").cast("long").alias("pos"), "comp",
        F.when(F.col("sig") == F.col("lead"), F.col("n")).otherwise(F.coalesce("shared", F.lit(-1))).cast("long").alias(
            "with_lead"), F.col("lead_n").cast("long").alias("lead_n"), "sketch", (F.col("own") == F.col("other")).alias("self"))
    rows = rows.withColumn("single", F.col("single") | F.col("self")).drop("self")
    # members of the part of a block with itself are alone there; parts of two blocks hold both
    opened = written(rows.repartition("part").sortWithinPartitions("part").mapInArrow(
        _open_batches, "a long, b long, forced boolean").distinct(), "open", folder)
    labels = merged(labels, opened.where("forced").select("a", "b"), "forced", folder)
    clusters = components(opened.where("NOT forced").select("a", "b"), "clusters", folder)
    return merged(labels, cluster_links(clusters, labels, sketched, texts, folder), "linked", folder)


def _key(key: str) -> Column:
    return F.coalesce(F.col(f"`{key}`").cast("long"), F.lit(_LAST))


def groups(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc (the key; nulls last, as the largest number), text_hash, n_shingles, label and component_id of every document.

    The label, null without a set, tells components apart whose smallest keys are equal.
    """
    texts = docs.select(_key(key).alias("doc"), F.col(f"`{text}`").cast("binary").alias("text"),
                        F.xxhash64(F.col(f"`{text}`").cast("binary")).alias("text_hash"))
    spark = docs.sparkSession
    with small_batches(spark, TEXTS_PER_BATCH):
        found = written(texts.mapInArrow(_class_batches, "doc long, text_hash long, n long, sig long, sketch binary"),
                        "classes")
    common = _bitmap(found.where("n = -1").select(F.col("sig").alias("bit")), "bit", COMMON_BITS)
    classes = found.where("n >= 0").drop("sketch")
    with small_batches(spark, SETS_PER_BATCH), freed_shuffles(spark):
        labels = labels_of(texts, common, found.where("sketch IS NOT NULL").select("sig", "n", "sketch"))
    salted = classes.withColumn("salt", F.pmod(F.xxhash64("doc"), F.lit(SALTS)).cast("int"))
    by_salt = salted.where("n > 0").groupBy("sig", "salt").agg(F.min("doc").alias("first"))
    firsts = by_salt.groupBy("sig").agg(F.min("first").alias("first"), F.collect_list("salt").alias("salts"))
    named = written(firsts.join(labels.withColumnRenamed("node", "sig"), "sig", "left").select(
        "sig", "first", "salts", F.coalesce("label", "sig").alias("label"), F.col("label").isNotNull().alias("many")),
        "named")
    smallest = named.where("many").groupBy("label").agg(F.min("first").alias("least"))
    placed = named.join(smallest, "label", "left").select(
        "sig", F.explode("salts").alias("salt"), "label", F.coalesce("least", "first").alias("component_id"))
    return salted.join(placed, ["sig", "salt"], "left").select(
        "doc", "text_hash", F.col("n").alias("n_shingles"), "label",
        F.coalesce("component_id", "doc").alias("component_id"))


def joined(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, n_shingles and component_id of every document; a null key names a component if it is alone."""
    out = groups(docs, key, text)

    def plain(c):
        return F.when(F.col(c) != _LAST, F.col(c))

    return out.select(plain("doc").alias(key), "n_shingles", plain("component_id").alias("component_id"))


def representatives(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of ``docs`` for each component: that of the smallest key, nulls last, and of rows of that key the one of
    the smallest text hash; of rows equal in key and text, one. Rows without words all stay.
    """
    out = written(groups(docs, key, text).select("doc", "text_hash", "label"), "grouped")
    row = F.struct("doc", "text_hash")
    # all rows of a label agree on key and text but for a few, so partial minima leave little to shuffle
    chosen = out.where("label IS NOT NULL").groupBy("label").agg(F.min(row).alias("row")).select("row.*")
    wordless = out.where("label IS NULL").select("doc", "text_hash").distinct()
    repeats = out.groupBy("doc", "text_hash").agg((F.count("*") > 1).alias("again"))
    plan = chosen.withColumn("whole", F.lit(False)).union(wordless.withColumn("whole", F.lit(True))).join(
        repeats, ["doc", "text_hash"]).select("doc", "text_hash", (F.col("whole") | ~F.col("again")).alias("plain"))
    names = docs.columns
    held = docs.select(*[F.col(f"`{c}`").alias(f"__c{k}") for k, c in enumerate(names)], _key(key).alias("doc"),
                       F.xxhash64(F.col(f"`{text}`").cast("binary")).alias("text_hash")).join(plan, ["doc", "text_hash"])
    once = held.where("NOT plain").dropDuplicates(["doc", "text_hash"])
    return held.where("plain").unionByName(once).select(*[F.col(f"__c{k}").alias(c) for k, c in enumerate(names)])

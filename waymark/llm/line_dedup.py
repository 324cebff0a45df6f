"""Line dedup: documents that share rare lines are aligned in pairs, and common blocks leave the later document.

A block is a run of lines that two documents have in common, of ``MIN_WORDS`` words or more. Each line of a block lies
in a run inside it that is the shortest of so many words from a line on, or up to a line; hashes of those runs are the
keys, so that whoever holds a key holds a whole block. A key in one document only is dropped; a key of several names
their first as the partner of all others, so a block that a third of all documents share gives one pair each, not all
pairs, and every line that any earlier document has in a common block is met in some first holder.

A pair is aligned by patience diff: lines unique in both anchor the longest increasing run, which grows to equal
neighbours and splits the rest, to be aligned in turn; where no line is unique, the first occurrence meets the first, the
second the second. Aligned runs of MIN_WORDS words or more are deleted from the later document. What one alignment can't
hold, as repeated passages and passages in another order, is aligned again, now by its runs of MIN_WORDS words in place
of lines, until no such run that both documents hold is left. Nothing is deleted but by an alignment, and no run of
MIN_WORDS words that an earlier document holds as it came is left.

Documents are ordered by key, then by a hash of the text. Defined results: null and empty texts stay as they are;
rows with a null key come last in the order; rows equal in key and text are one document and all stay; lines without
words never make a block by themselves; text is split at \\n only and kept lines are joined by it. An empty table
gives an empty result. All columns of the input are returned as they came, but for the text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.llm.tables import written
from waymark.llm.text import chunks, mixed, owners, powers

MIN_WORDS = 20
SALTS = 64


def minimal_runs(lines: np.ndarray, words: np.ndarray, bounds: np.ndarray, min_words: int
                 ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First line, last line and key of the shortest runs of ``min_words`` words from each line on and up to each line.

    ``lines`` are hashes; document k has the lines from ``bounds[k]`` to ``bounds[k + 1]``. Every line of a block lies
    in such a run inside the block.
    """
    n = len(lines)
    total = np.concatenate(([0], np.cumsum(words, dtype=np.int64)))
    own = owners(bounds)
    at = np.arange(n)
    end = np.searchsorted(total, total[:-1] + min_words, "left") - 1
    begin = np.searchsorted(total, total[1:] - min_words, "right") - 1
    onward, upto = end < bounds[1:][own], begin >= bounds[:-1][own]
    first = np.concatenate((at[onward], begin[upto]))
    last = np.concatenate((end[onward], at[upto]))
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(lines * powers(n), out=sums[1:])
    raw = (sums[last + 1] - sums[first]) * powers(n, inverse=True)[first]
    return first, last, mixed(raw + (last - first).astype(np.uint64))


def _line_batches(min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column(1)):
                begin, end, bounds = chunk.lines()
                hashes = chunk.hashes(begin, end)
                words = np.searchsorted(first := chunk.words()[0], end) - np.searchsorted(first, begin)
                start, _, own = minimal_runs(hashes, words, bounds, min_words)
                doc = owners(bounds)[start]
                order = np.lexsort((own, doc))
                doc, own = doc[order], own[order]
                new = np.append(True, (doc[1:] != doc[:-1]) | (own[1:] != own[:-1]))[:len(own)]
                doc, own = doc[new], own[new].view(np.int64)
                edges = np.searchsorted(doc, np.arange(chunk.n + 1))
                part = batch.slice(chunk.first, chunk.n)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), _lists(hashes.view(np.int64), bounds), _lists(words.astype(np.int32), bounds),
                     _lists(own, edges)], names=["who", "lines", "sizes", "keys"])

    return run


def _lists(values: np.ndarray, bounds: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values))


def aligned(later: list[int], earlier: list[int]) -> list[tuple[int, int]]:
    """Matched places of two sequences, in order, by patience diff; whatever they have in common, one place is matched."""
    out, todo = [], [(0, len(later), 0, len(earlier))]
    while todo:
        a, b, c, d = todo.pop()
        while a < b and c < d and later[a] == earlier[c]:
            out.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and later[b - 1] == earlier[d - 1]:
            b, d = b - 1, d - 1
            out.append((b, d))
        if a >= b or c >= d:
            continue
        count: dict[int, list[int]] = {}
        for n in range(a, b):
            count.setdefault(later[n], [0, 0, n, 0])[0] += 1
        for n in range(c, d):
            seen = count.get(later_line := earlier[n])
            if seen:
                seen[1] += 1
                seen[3] = n
                count[later_line] = seen
        anchors = _rising([(v[2], v[3]) for v in count.values() if v[0] == v[1] == 1])
        if not anchors:
            anchors = _rising(_by_occurrence(later, range(a, b), earlier, range(c, d)))
        if not anchors:
            continue
        edge = (a, c)
        for i, j in [*anchors, (b, d)]:
            todo.append((edge[0], i, edge[1], j))
            if i < b:
                out.append((i, j))
            edge = (i + 1, j + 1)
    return sorted(out)


def _by_occurrence(later: list[int], at: range, earlier: list[int], of: range) -> list[tuple[int, int]]:
    """The first place of each value with its first place in the other sequence, the second with the second."""
    places: dict[int, list[int]] = {}
    for j in reversed(of):
        places.setdefault(earlier[j], []).append(j)
    return [(i, places[later[i]].pop()) for i in at if places.get(later[i])]


def _rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest run of pairs, in order of the first number, whose second numbers rise."""
    from bisect import bisect_left

    ends, last, back = [], [], {}
    for n, (_, j) in enumerate(pairs):
        at = bisect_left(ends, j)
        ends[at:at + 1], last[at:at + 1] = [j], [n]
        back[n] = last[at - 1] if at else None
    run, n = [], last[-1] if last else None
    while n is not None:
        run.append(pairs[n])
        n = back[n]
    return run[::-1]


def _without_repeats(values: list[int]) -> Iterator[tuple[int, int]]:
    """Pieces, as long as can be, in which no value occurs twice."""
    start, seen = 0, set()
    for n, value in enumerate(values):
        if value in seen:
            yield start, n
            start, seen = n, set()
        seen.add(value)
    yield start, len(values)


def _runs(lines: list[int], sizes: list[int], min_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The minimal runs of one document, in order: first line, last line, key."""
    first, last, key = minimal_runs(np.array(lines, np.int64).view(np.uint64), np.array(sizes, np.int64),
                                    np.array([0, len(lines)]), min_words)
    order = np.lexsort((last, first))
    return first[order], last[order], key[order]


def common_blocks(later: list[int], sizes: list[int], earlier: list[int], min_words: int) -> list[int]:
    """Line numbers of the later document that lie in runs of at least ``min_words`` words both documents hold.

    Lines are aligned first. Runs that are left are aligned in turn, each time those still left; a document that repeats
    a passage more often than the earlier one is aligned piece by piece.
    """
    gone, run = np.zeros(len(later), bool), []
    for pair in [*aligned(later, earlier), (-9, -9)]:
        if run and (pair[0] != run[-1][0] + 1 or pair[1] != run[-1][1] + 1):
            if sum(sizes[i] for i, _ in run) >= min_words:
                gone[run[0][0]:run[-1][0] + 1] = True
            run = []
        run.append(pair)
    if gone.all():
        return list(range(len(later)))
    words = dict(zip(later, sizes, strict=True))
    first, last, key = _runs(later, sizes, min_words)
    # a line that only the earlier document has counts 0 words: no run that both hold has one
    known = _runs(earlier, [words.get(x, 0) for x in earlier], min_words)[2]
    open_ = np.flatnonzero(np.isin(key, known))
    again = False
    while True:
        done = np.concatenate(([0], np.cumsum(gone)))
        open_ = open_[done[last[open_] + 1] - done[first[open_]] < last[open_] + 1 - first[open_]]
        mine, theirs = key[open_].tolist(), known[np.isin(known, key[open_])].tolist()
        matched = [a + i for a, b in (_without_repeats(mine) if again else [(0, len(mine))])
                   for i, _ in aligned(mine[a:b], theirs)]
        if not matched:
            return np.flatnonzero(gone).tolist()
        for n in open_[matched]:
            gone[first[n]:last[n] + 1] = True
        again = True


def _align_batches(min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(n, 512) for n in range(0, batch.num_rows, 512)):
                gone = [common_blocks(a, s, b, min_words) for a, s, b in zip(
                    *(part.column(n).to_pylist() for n in (1, 2, 3)), strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(gone, pa.list_(pa.int32()))],
                                                 names=["later", "gone"])

    return run


def first_holders(rows: DataFrame, key: str, who: str) -> DataFrame:
    """``rows`` (key, who) that are not their key's first, with that first; a hot key is met on SALTS sides."""
    salted = rows.withColumn("__salt", F.pmod(F.xxhash64(who), F.lit(SALTS)).cast("int"))
    by_salt = salted.groupBy(key, "__salt").agg(F.min(who).alias("first"), F.count("*").alias("n"))
    firsts = by_salt.groupBy(key).agg(F.min("first").alias("first"), F.sum("n").alias("n"),
                                      F.collect_list("__salt").alias("salts"))  # at most SALTS
    firsts = firsts.where("n > 1").select(key, F.explode("salts").alias("__salt"), "first")
    return salted.join(firsts, [key, "__salt"]).where(F.col(who) != F.col("first")).drop("__salt")


def _who(key: str, text: str):
    k = F.col(f"`{key}`")
    return F.struct(k.isNull().alias("absent"), F.coalesce(k.cast("long"), F.lit(0)).alias("id"),
                    F.xxhash64(F.col(f"`{text}`")).alias("text"))


def deletions(docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """who (absent, id, text hash), gone (numbers of the lines to delete) of documents that lose lines."""
    kind = "struct<absent:boolean,id:bigint,text:bigint>"
    source = docs.where(F.col(f"`{text}`").isNotNull()).select(
        _who(key, text).alias("who"), F.col(f"`{text}`").cast("binary").alias("__text"))
    lines = written(source.mapInArrow(
        _line_batches(min_words), f"who {kind}, lines array<long>, sizes array<int>, keys array<long>"), "lines")
    keys = lines.select("who", F.explode("keys").alias("key")).distinct()
    pairs = written(first_holders(keys, "key", "who").select(F.col("who").alias("later"), F.col("first")).distinct(),
                    "pairs")
    once = lines.groupBy("who").agg(F.first("lines").alias("lines"), F.first("sizes").alias("sizes"))
    met = pairs.join(once.select(F.col("who").alias("first"), F.col("lines").alias("earlier")), "first") \
        .join(once.withColumnRenamed("who", "later"), "later").select("later", "lines", "sizes", "earlier")
    gone = met.mapInArrow(_align_batches(min_words), f"later {kind}, gone array<int>")
    return gone.where(F.size("gone") > 0).groupBy(F.col("later").alias("who")).agg(
        F.array_distinct(F.flatten(F.collect_list("gone"))).alias("gone"))


def deduplicated(docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with common blocks removed from the text of later documents; every row stays."""
    gone = written(deletions(docs, key, text, min_words), "gone")
    names = docs.columns
    plain = docs.select(*[F.col(f"`{c}`").alias(f"__c{n}") for n, c in enumerate(names)], _who(key, text).alias("who"))
    t = F.col(f"__c{names.index(text)}")
    left = F.array_join(F.filter(F.split(t, "\n", -1), lambda line, n: ~F.array_contains("gone", n)), "\n")
    whole = F.when(F.col("gone").isNull(), t).otherwise(left)
    return plain.join(gone.hint("merge"), "who", "left").select(  # one plan at every size
        *[(whole if c == text else F.col(f"__c{n}")).alias(c) for n, c in enumerate(names)])

"""Collocations: phrases of two and three words that hold together, counted in HAT-tries.

Each place of a text gives one path of word ids, the 64-bit hashes of its word and of up to two more words of the same
piece. A task keeps a HAT-trie for each language: inner nodes deal words out by ranges of ids to containers, which are
hash tables of path suffixes with counts. A container that outgrows ``BURST`` paths bursts: into two ranges, or, once
it holds a single word, into a node one word deeper. Counts of words and pairs are the sums below their nodes. When
the tries of a task outgrow ``SPILL`` paths, the largest subtrees leave whole as sorted runs, in which paths share
their first and second words; a run is cut by prefix partition, the hash of the first word and of 4 bits of the second,
so that a frequent word is spread over 16 partitions. A partition merges its runs and keeps what occurs ``least`` times
or more; a part of such a phrase occurs at least as often, so nothing that a score needs is lost. Scores, cuts, the
dropping of what a longer candidate covers and the ranks are joins and windows on what is left.

Arithmetic is exact: products are decimals of 38 digits, divided as integers.

Defined results: a null or empty text has no words; a null language is ``und``, together with rows that say so; equal
rows all count; words of any length are words; equal scores and counts are ranked by phrase, in UTF-8 byte order, so
ranks are unique; an empty table gives an empty result. Columns other than text and language are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymark.llm.tables import written
from waymark.llm.text import Chunk, byte_set, chunks, mixed, runs

BURST = 1 << 16
SPILL = 1 << 20
SPILL_WORDS = 1 << 18
PART_BYTES = 8_000_000
SALTS = 64
#: Ends of pieces, ``[.,;:!?\x0A-\x0D]``, and of words, which space and tab end too.
_PIECE_END = byte_set(*[(ord(c), ord(c)) for c in ".,;:!?"], (0x0A, 0x0D))
_WORD_END = _PIECE_END | byte_set((0x20, 0x20), (0x09, 0x09))
_U = np.uint64

Paths = list[np.ndarray]  # one column of word ids for each word left, then the counts


class Container:
    """A hash table of path suffixes with counts; new paths wait until there are enough to be worth adding up."""

    def __init__(self, width: int):
        self.width, self.rows, self.waiting, self.size = width, None, [], 0

    def insert(self, paths: Paths) -> None:
        self.waiting.append(paths)
        self.size += len(paths[-1])

    def added_up(self) -> Paths:
        if self.waiting:
            every = [np.concatenate(c) for c in zip(*([self.rows] if self.rows else []), *self.waiting)]
            names = [str(n) for n in range(self.width)]
            table = pa.table(every, names=[*names, "n"]).group_by(names, use_threads=False).aggregate([("n", "sum")])
            self.rows = [table[n].to_numpy() for n in [*names, "n_sum"]]
            self.waiting, self.size = [], len(table)
        return self.rows or [np.zeros(0, np.uint64)] * self.width + [np.zeros(0, np.int64)]

    def sorted(self) -> Paths:
        rows = self.added_up()
        order = np.lexsort(rows[-2::-1])
        return [c[order] for c in rows]


class Node:
    """Deals paths out by their first word: ``bounds`` are the first ids of the kids' ranges."""

    def __init__(self, width: int):
        self.width, self.bounds, self.kids = width, np.zeros(1, np.uint64), [Container(width)]

    @property
    def size(self) -> int:
        return sum(k.size for k in self.kids)

    def insert(self, paths: Paths) -> None:
        kid = np.searchsorted(self.bounds, paths[0], "right") - 1
        order = np.argsort(kid, kind="stable")
        paths, kid = [c[order] for c in paths], kid[order]
        cuts = np.flatnonzero(np.diff(kid)) + 1
        for low, high in reversed([*zip([0, *cuts], [*cuts, len(kid)])]):  # from behind, as bursts add kids
            self._insert_into(int(kid[low]), [c[low:high] for c in paths])

    def _insert_into(self, n: int, paths: Paths) -> None:
        kid = self.kids[n]
        if isinstance(kid, Node):
            kid.insert(paths[1:])
            return
        kid.insert(paths)
        if kid.size > 2 * BURST:
            rows = kid.added_up()
            if len(rows[-1]) > BURST:
                self._burst(n, rows)

    def _burst(self, n: int, rows: Paths) -> None:
        first = np.sort(rows[0])
        low, high, middle = first[0], first[-1], first[len(first) // 2]
        if low == high and self.width > 1:  # one word: a node of its own, with empty ranges on both sides
            node = Node(self.width - 1)
            node.insert(rows[1:])
            self._replace(n, [(self.bounds[n], Container(self.width)), (low, node),
                              *([(low + _U(1), Container(self.width))] if low < np.iinfo(np.uint64).max else [])])
            return
        if low == high:
            return  # a single path
        middle = middle if middle > low else first[np.searchsorted(first, middle, "right")]
        kids = []
        for start, held in ((self.bounds[n], rows[0] < middle), (middle, rows[0] >= middle)):
            kid = Container(self.width)
            kid.rows = [c[held] for c in rows]
            kid.size = len(kid.rows[-1])
            kids.append((start, kid))
        self._replace(n, kids)

    def _replace(self, n: int, kids: list) -> None:
        self.bounds = np.concatenate([self.bounds[:n], np.array([b for b, _ in kids], np.uint64), self.bounds[n + 1:]])
        self.kids[n:n + 1] = [k for _, k in kids]

    def sorted(self) -> Paths:
        parts = []
        for bound, kid in zip(self.bounds, self.kids):
            rows = kid.sorted()
            parts.append([np.full(len(rows[-1]), bound, np.uint64), *rows] if isinstance(kid, Node) else rows)
        return [np.concatenate(c) for c in zip(*parts)]

    def take_largest(self) -> Paths:
        """Takes out the largest subtree, as a sorted run."""
        n = max(range(len(self.kids)), key=lambda k: self.kids[k].size)
        rows = self.kids[n].sorted()
        if isinstance(self.kids[n], Node):
            rows = [np.full(len(rows[-1]), self.bounds[n], np.uint64), *rows]
        self.kids[n] = Container(self.width)
        return rows


def paths_of(chunk: Chunk) -> tuple[Paths, np.ndarray, np.ndarray]:
    """A path of three words for each place (0 where the piece is over), and where each word begins and ends."""
    begin, end, _ = runs(chunk.lowered(), _WORD_END)
    ids = chunk.hashes(begin, end)
    ids[ids == 0] = 1
    piece = np.cumsum(_PIECE_END[chunk.data])[begin]
    paths = [ids]
    for k in (1, 2):
        after = np.zeros(len(ids), np.uint64)
        if len(ids) > k:
            after[:-k] = np.where(piece[k:] == piece[:-k], ids[k:], _U(0))
        paths.append(after)
    return [*paths, np.ones(len(ids), np.int64)], begin, end


def _part(first: np.ndarray, second: np.ndarray, bits: int) -> np.ndarray:
    if not bits:
        return np.zeros(len(first), np.int64)
    return (mixed(first + (second & _U(15))) >> _U(64 - bits)).astype(np.int64)


_COLUMNS = ("heads", "head_sizes", "seconds", "second_sizes", "thirds", "counts", "texts")
_RUNS = "part int, lang string, of_words boolean, " + ", ".join(f"{c} binary" for c in _COLUMNS)


def _packed(paths: Paths) -> dict[str, bytes]:
    """A sorted run in which paths share their first and second words."""
    first, second, third, n = paths
    pair = np.flatnonzero(np.concatenate(([True], (first[1:] != first[:-1]) | (second[1:] != second[:-1]))))
    head = np.flatnonzero(np.concatenate(([True], first[pair[1:]] != first[pair[:-1]])))
    return {"heads": first[pair[head]].tobytes(),
            "head_sizes": np.diff(np.append(head, len(pair))).astype(np.uint32).tobytes(),
            "seconds": second[pair].tobytes(),
            "second_sizes": np.diff(np.append(pair, len(first))).astype(np.uint32).tobytes(),
            "thirds": third.tobytes(), "counts": n.astype(np.uint32).tobytes()}


def _unpacked(run: dict[str, bytes]) -> Paths:
    read = lambda name, kind: np.frombuffer(run[name], kind)
    sizes = read("second_sizes", np.uint32)
    first = np.repeat(np.repeat(read("heads", np.uint64), read("head_sizes", np.uint32)), sizes)
    return [first, np.repeat(read("seconds", np.uint64), sizes), read("thirds", np.uint64),
            read("counts", np.uint32).astype(np.int64)]


class _Task:
    """The tries and words of one task, by language."""

    def __init__(self, bits: int):
        self.bits, self.tries, self.words, self.n_words = bits, {}, {}, 0

    def add(self, lang: str, chunk: Chunk) -> None:
        paths, begin, end = paths_of(chunk)
        if not len(begin):
            return
        self.tries.setdefault(lang, Node(3)).insert(paths)
        words = self.words.setdefault(lang, {})
        distinct, at, n = np.unique(paths[0], return_index=True, return_counts=True)
        data, before = chunk.data.tobytes(), len(words)
        for word, low, high, count in zip(distinct.tolist(), begin[at].tolist(), end[at].tolist(), n.tolist()):
            known = words.get(word)
            if known is None:
                words[word] = [data[low:high], count]
            else:
                known[1] += count
        self.n_words += len(words) - before

    def spill(self, limit: int) -> Iterator[tuple]:
        size = {lang: trie.size for lang, trie in self.tries.items()}
        total = sum(size.values())
        while total > limit:
            lang = max(size, key=size.get)
            yield from self._run(lang, self.tries[lang].take_largest())
            total -= size[lang]
            size[lang] = self.tries[lang].size
            total += size[lang]

    def _run(self, lang: str, paths: Paths) -> Iterator[tuple]:
        part = _part(paths[0], paths[1], self.bits)
        order = np.argsort(part, kind="stable")  # paths stay sorted within a part
        part, paths = part[order], [c[order] for c in paths]
        cuts = np.flatnonzero(np.diff(part)) + 1
        for low, high in zip([0, *cuts], [*cuts, len(part)]) if len(part) else ():
            run = _packed([c[low:high] for c in paths])
            yield int(part[low]), lang, False, *[run.get(c) for c in _COLUMNS]

    def spill_words(self) -> Iterator[tuple]:
        for lang, words in self.words.items():
            ids = np.array(list(words), np.uint64)
            part = _part(ids, np.zeros_like(ids), self.bits)
            order = np.argsort(part, kind="stable")
            rows = list(words.values())
            cuts = np.flatnonzero(np.diff(part[order])) + 1
            for at in np.split(order, cuts) if len(order) else ():
                run = {"heads": ids[at].tobytes(), "counts": np.array([rows[k][1] for k in at], np.uint32).tobytes(),
                       "texts": b"\n".join([rows[k][0] for k in at])}
                yield int(part[at[0]]), lang, True, *[run.get(c) for c in _COLUMNS]
        self.words, self.n_words = {}, 0


def _batches(rows: Iterable[tuple]) -> Iterator[pa.RecordBatch]:
    types = [pa.int32(), pa.string(), pa.bool_(), *[pa.binary()] * len(_COLUMNS)]
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(b) for b in row[3:] if b)
        if size > 4_000_000:
            yield _batch(held, types)
            held, size = [], 0
    if held:
        yield _batch(held, types)


def _batch(rows: list[tuple], types: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)],
                                      ["part", "lang", "of_words", *_COLUMNS])


def _counter(bits: int, spill: int):
    """The ``mapInArrow`` function from documents to sorted runs of paths and of words."""
    def rows(batches):
        task = _Task(bits)
        for batch in batches:
            lang = batch.column("lang").dictionary_encode()
            codes = lang.indices.to_numpy()
            for code, name in enumerate(lang.dictionary.to_pylist()):
                for chunk in chunks(batch.column("text").take(pa.array(np.flatnonzero(codes == code)))):
                    task.add(name, chunk)
                    yield from task.spill(spill)
                    if task.n_words > SPILL_WORDS:
                        yield from task.spill_words()
        yield from task.spill(0)
        yield from task.spill_words()

    return lambda batches: _batches(rows(batches))


_COUNTS = "lang string, size int, w1 long, w2 long, w3 long, word string, f long"


def _merged(least: int):
    """The ``mapInArrow`` function from runs sorted by part, kind and language to counts of words and phrases."""
    def words(lang, held):
        ids = np.concatenate([np.frombuffer(r["heads"], np.uint64) for r in held])
        n = np.concatenate([np.frombuffer(r["counts"], np.uint32) for r in held]).astype(np.int64)
        texts = [t for r in held for t in r["texts"].split(b"\n")]
        order = np.argsort(ids, kind="stable")
        first = np.flatnonzero(np.concatenate(([True], np.diff(ids[order]) != 0)))
        f = np.add.reduceat(n[order], first)
        kept = f >= least
        found = order[first[kept]]
        yield _counted(lang, 0, [], [int(n.sum())])
        yield _counted(lang, 1, [ids[found]], f[kept], [texts[k].decode() for k in found])

    def phrases(lang, held):
        paths = [np.concatenate(c) for c in zip(*map(_unpacked, held))]
        order = np.lexsort(paths[2::-1])
        first, second, third, n = [c[order] for c in paths]
        new = np.concatenate(([True], (first[1:] != first[:-1]) | (second[1:] != second[:-1])))
        for size, starts in ((2, new), (3, new | np.concatenate(([True], third[1:] != third[:-1])))):
            at = np.flatnonzero(starts)
            f = np.add.reduceat(n, at)
            kept = (f >= least) & ((second, third)[size - 2][at] != 0)
            yield _counted(lang, size, [c[at[kept]] for c in (first, second, third)[:size]], f[kept])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []
        for batch in batches:
            for row in batch.to_pylist():
                group = (row["part"], row["of_words"], row["lang"])
                if group != at:
                    if held:
                        yield from (words if at[1] else phrases)(at[2], held)
                    at, held = group, []
                held.append(row)
        if held:
            yield from (words if at[1] else phrases)(at[2], held)

    return run


def _counted(lang: str, size: int, ids: list[np.ndarray], f, texts: list[str] | None = None) -> pa.RecordBatch:
    n = len(f)
    ids = [pa.array(c.view(np.int64)) for c in ids] + [pa.nulls(n, pa.int64())] * (3 - len(ids))
    return pa.RecordBatch.from_arrays(
        [pa.array([lang] * n, pa.string()), pa.array([size] * n, pa.int32()), *ids,
         pa.array(texts, pa.string()) if texts else pa.nulls(n, pa.string()), pa.array(f, pa.int64())],
        ["lang", "size", "w1", "w2", "w3", "word", "f"])


def phrase_counts(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = 10,
                  part_bytes: int = PART_BYTES, spill: int = SPILL) -> DataFrame:
    """lang, size, w1, w2, w3, word and f of words (size 1) and phrases of 2 and 3 words that occur ``least`` times,
    with all occurrences of words as rows of size 0; written."""
    plain = docs.select(F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang"),
                        F.col(f"`{text}`").cast("string").alias("text"))
    size = plain.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    bits = max(0, (int(size) // part_bytes).bit_length())
    found = plain.mapInArrow(_counter(bits, spill), _RUNS).repartition(1 << bits, "part") \
        .sortWithinPartitions("part", "of_words", "lang")
    return written(found.mapInArrow(_merged(least), _COUNTS), "phrases")


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = 10, covered: int = 50,
                 top: int = 2000, **options) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of each language's first ``top`` phrases.

    A phrase is dropped where a longer one around it has at least ``covered`` per cent of its occurrences.
    """
    counts = phrase_counts(docs, text, lang, least, **options)
    total = counts.where("size = 0").groupBy("lang").agg(F.sum("f").alias("n"))
    word = counts.where("size = 1").select("lang", "w1", "word", "f")
    pair = counts.where("size = 2").select("lang", "w1", "w2", F.col("f").alias("a"))
    triple = counts.where("size = 3").select("lang", "w1", "w2", "w3", F.col("f").alias("a"))

    def with_word(rows, n):
        return rows.join(word.toDF("lang", f"w{n}", f"word{n}", f"f{n}"), ["lang", f"w{n}"])

    longer = triple.select("lang", "a", F.explode(F.array(
        F.struct("w1", "w2"), F.struct(F.col("w2").alias("w1"), F.col("w3").alias("w2")))).alias("p")) \
        .groupBy("lang", "p.w1", "p.w2").agg(F.max("a").alias("longest"))
    pairs = pair.join(longer, ["lang", "w1", "w2"], "left") \
        .where(F.col("longest").isNull() | (100 * F.col("longest") < covered * F.col("a")))
    pairs = with_word(with_word(pairs, 1), 2).select(
        "lang", F.concat_ws(" ", "word1", "word2").alias("phrase"), "a", F.col("f1").alias("l"), F.col("f2").alias("r"),
        _score("a", "f1", "f2").alias("score"))
    cut = F.least(*[F.struct(_score("a", x, y).alias("score"), F.lit(k).alias("k"), F.col(x).alias("l"), F.col(y).alias("r"))
                    for k, (x, y) in enumerate((("f1", "f23"), ("f12", "f3")))])
    triples = with_word(with_word(with_word(triple, 1), 2), 3) \
        .join(pair.toDF("lang", "w1", "w2", "f12"), ["lang", "w1", "w2"]) \
        .join(pair.toDF("lang", "w2", "w3", "f23"), ["lang", "w2", "w3"]) \
        .select("lang", F.concat_ws(" ", "word1", "word2", "word3").alias("phrase"), "a", cut.alias("cut")) \
        .select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    salted = pairs.unionByName(triples).withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    for group in (["lang", "salt"], ["lang"]):  # the first window bounds what the second has of a language
        order = Window.partitionBy(*group).orderBy(F.desc("score"), F.desc("a"), "phrase")
        salted = salted.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return salted.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _score(a: str, left: str, right: str) -> Column:
    """floor(1000000 a a / (l r)), exactly."""
    return F.expr(f"(CAST(1000000 AS DECIMAL(7,0)) * CAST({a} AS DECIMAL(15,0)) * CAST({a} AS DECIMAL(15,0)))"
                  f" DIV (CAST({left} AS DECIMAL(19,0)) * CAST({right} AS DECIMAL(19,0)))")

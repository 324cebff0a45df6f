"""Toxicity by a classifier chain: categories in order, each linear model fed with the earlier probabilities.

Labels only say toxic or not. A labelled toxic document is of a seeded category if it holds one of the category's
seed words, and of category ``other`` if it holds none; the last link of the chain is ``toxic`` itself. Every link is
a logistic regression over words and word beginnings that tell classes apart. A later link trains on out-of-fold
probabilities of the earlier ones, as it will see theirs on unseen documents, never on fitted ones.

Training reads at most ``MAX_LABELLED`` labelled documents of ``MAX_LABELLED_BYTES``, those of lowest hash; scoring covers every document, in
one pass without a shuffle. The model is some thousand hashes with weights, whatever the input's size.

Defined results: a null or empty text has no features and gets the models' bias; labels that are null are no labels;
an id labelled both ways is toxic; of several texts with one id, one counts for training, by hash;
repeated rows score alike; with an empty or one-class label table every probability is that class's share (0 without
labels); an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waymark.llm.tables import written
from waymark.llm.text import Chunk, chunks, mixed, owners

#: Seed words of the seeded categories.
SEEDS = {
    "insult": "idiot moron clown loser stupid".split(),
    "contempt": "trash scum worthless pathetic disgusting".split(),
}
CATEGORIES = (*SEEDS, "other", "toxic")
MAX_LABELLED = 4000
MAX_LABELLED_BYTES = 64 << 20
MAX_FEATURES = 1000
FOLDS = 3
THRESHOLD = 0.5
_PREFIXES = (5, 6, 7, 8)
_SPACES = np.arange(256, dtype=np.uint8)
for _b in range(128):
    if not chr(_b).isalnum() and _b != 10:
        _SPACES[_b] = 32


def _features(chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words and their beginnings, and the document of each."""
    chunk.lowered()
    chunk.data = _SPACES[chunk.data]
    begin, end, bounds = chunk.words()
    own = owners(bounds)
    hashes, docs = [chunk.hashes(begin, end)], [own]
    for n in _PREFIXES:
        long = end - begin > n
        hashes.append(mixed(chunk.hashes(begin[long], begin[long] + n) + np.uint64(n)))
        docs.append(own[long])
    return np.concatenate(hashes), np.concatenate(docs)


def _seed_hashes() -> list[np.ndarray]:
    out = []
    for words in SEEDS.values():
        (chunk,) = chunks(pa.array(words))
        begin, end, _ = chunk.words()
        out.append(chunk.hashes(begin, end))
    return out


def _distinct_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for chunk in chunks(batch.column(2)):
            hashes, own = _features(chunk)
            part = batch.slice(chunk.first, chunk.n)
            order = np.lexsort((hashes, own))
            hashes, own = hashes[order], own[order]
            new = np.append(True, (hashes[1:] != hashes[:-1]) | (own[1:] != own[:-1]))[:len(own)]
            ends = np.searchsorted(own[new], np.arange(chunk.n + 1)).astype(np.int32)
            found = pa.ListArray.from_arrays(ends, pa.array(hashes[new].view(np.int64)))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), found], names=["id", "toxic", "features"])


@dataclass
class Link:
    """One category's logistic model: features, their weights, weights of earlier probabilities, bias."""

    features: np.ndarray
    weights: np.ndarray
    earlier: np.ndarray
    bias: float

    def scores(self, rows: tuple[np.ndarray, np.ndarray], n: int, before: np.ndarray) -> np.ndarray:
        hashes, own = rows
        place = np.minimum(np.searchsorted(self.features, hashes), max(len(self.features) - 1, 0))
        if len(self.features):
            hit = self.features[place] == hashes
            pairs = np.unique(np.stack((own[hit], place[hit]), axis=1), axis=0) if hit.any() else np.zeros((0, 2), int)
            linear = np.bincount(pairs[:, 0], self.weights[pairs[:, 1]], minlength=n)[:n]
        else:
            linear = np.zeros(n)
        linear = linear + self.bias + (before @ self.earlier if before.shape[1] else 0)
        return 1 / (1 + np.exp(-np.clip(linear, -40, 40)))


class Design:
    """Feature sets of documents as two arrays, features and owners; features of fewer than three documents go."""

    def __init__(self, rows: list[np.ndarray]):
        self.n = len(rows)
        flat = np.concatenate(rows) if rows else np.zeros(0, np.uint64)
        own = np.repeat(np.arange(self.n), [len(r) for r in rows]).astype(np.int32)
        names, at, seen = np.unique(flat, return_inverse=True, return_counts=True)
        often = seen >= 3
        use = often[at]
        self.names = names[often]
        self.at, self.own = (np.cumsum(often) - 1)[at[use]].astype(np.int32), own[use]

    def fit(self, inside: np.ndarray, target: np.ndarray, before: np.ndarray, steps: int = 80) -> Link:
        """Logistic regression of the documents ``inside``, by gradient steps, over the features most unevenly
        spread over the classes."""
        n, hits = int(inside.sum()), float(target[inside].sum())
        if hits in (0.0, float(n)):
            share = hits / n if n else 0.0
            bias = float(np.log((share + 1e-6) / (1 - share + 1e-6)))
            return Link(np.zeros(0, np.uint64), np.zeros(0), np.zeros(before.shape[1]), bias)
        use = inside[self.own]
        at, own = self.at[use], self.own[use]
        seen = np.bincount(at, minlength=len(self.names))
        yes = np.bincount(at, target[own], minlength=len(self.names))
        expected = seen * hits / n
        gain = np.where(seen >= 3, (yes - expected) ** 2 / np.maximum(expected, 1e-9), 0)
        best = np.sort(np.argsort(-gain, kind="stable")[:MAX_FEATURES])
        best = best[gain[best] > 4]
        slot = np.full(len(self.names), -1)
        slot[best] = np.arange(len(best))
        use = slot[at] >= 0
        place = np.cumsum(inside) - 1
        x, d = slot[at[use]], place[own[use]]
        y, z = target[inside], before[inside]
        w, e, b = np.zeros(len(best)), np.zeros(z.shape[1]), float(np.log(hits / (n - hits)))
        size = np.full(len(best) + len(e) + 1, 1e-8)
        balance = np.where(y > 0, n / (2 * hits), n / (2 * (n - hits)))
        for _ in range(steps):
            linear = np.bincount(d, w[x], minlength=n) + z @ e + b
            error = balance * (1 / (1 + np.exp(-np.clip(linear, -40, 40))) - y) / n
            grad = np.concatenate((np.bincount(x, error[d], minlength=len(best)) + 1e-5 * w, z.T @ error + 1e-5 * e,
                                   [error.sum()]))
            size += grad ** 2
            step = 0.5 * grad / np.sqrt(size)
            w, e, b = w - step[:len(w)], e - step[len(w):-1], b - step[-1]
        return Link(self.names[best], w, e, float(b))


@dataclass
class Chain:
    links: list[Link] = field(default_factory=list)

    def probabilities(self, rows: tuple[np.ndarray, np.ndarray], n: int) -> np.ndarray:
        out = np.zeros((n, 0))
        for link in self.links:
            out = np.column_stack((out, link.scores(rows, n, out)))
        return out


def fit_chain(rows: list[np.ndarray], targets: np.ndarray, folds: np.ndarray) -> tuple[Chain, np.ndarray]:
    """The chain, and its out-of-fold probabilities of the rows it was fitted on."""
    chain, design, unseen = Chain(), Design(rows), np.zeros((len(rows), 0))
    everyone = np.ones(len(rows), bool)
    for c in range(targets.shape[1]):
        column = np.zeros(len(rows))
        for f in range(FOLDS):
            link = design.fit(folds != f, targets[:, c], unseen)
            out = folds == f
            use = out[design.own]
            flat = (design.names[design.at[use]], (np.cumsum(out) - 1)[design.own[use]])
            column[out] = link.scores(flat, int(out.sum()), unseen[out])
        chain.links.append(design.fit(everyone, targets[:, c], unseen))
        unseen = np.column_stack((unseen, column))
    return chain, unseen


def labelled_rows(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
                  most: int = MAX_LABELLED, most_bytes: int = MAX_LABELLED_BYTES
                  ) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """Ids, feature sets and labels of at most ``most`` labelled documents, the last of which passes ``most_bytes``."""
    own = labels.where(F.col(f"`{label}`").isNotNull() & F.col(f"`{key}`").isNotNull()).groupBy(
        F.col(f"`{key}`").cast("long").alias("id")).agg(F.max(F.col(f"`{label}`").cast("int")).alias("toxic"))
    texts = docs.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{text}`").cast("binary").alias("__text"))
    own = own.join(texts.select("id").distinct(), "id", "left_semi").orderBy(F.xxhash64("id"), "id").limit(most)
    own = written(own, "labels")  # at most ``most`` rows of two numbers, so they may be broadcast
    met = texts.join(F.broadcast(own), "id").groupBy("id", "toxic").agg(
        F.min_by("__text", F.struct(F.xxhash64("__text"), "__text")).alias("__text"))
    met = written(met, "labelled")
    # sizes of at most ``most`` rows in one window: the documents of lowest hash whose texts fit the bound
    upto = Window.orderBy(F.xxhash64("id"), "id").rowsBetween(Window.unboundedPreceding, -1)
    fit = met.select("id", F.octet_length("__text").alias("n")).withColumn(
        "before", F.coalesce(F.sum("n").over(upto), F.lit(0))).where(F.col("before") < most_bytes).select("id")
    table = met.join(F.broadcast(fit), "id").select("id", "toxic", "__text").mapInArrow(
        _distinct_batches, "id long, toxic int, features array<long>").toArrow()
    ids = table["id"].to_numpy()
    order = np.argsort(ids, kind="stable")
    lists = table["features"].combine_chunks()
    rows = [lists[int(n)].values.to_numpy().view(np.uint64) for n in order]
    return ids[order], rows, table["toxic"].to_numpy()[order].astype(float)


def trained(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic"
            ) -> tuple[Chain, np.ndarray, np.ndarray]:
    """The chain, with the labels and the out-of-fold probabilities of the rows it was fitted on."""
    ids, rows, toxic = labelled_rows(docs, labels, key, text, label)
    seeded = np.array([[np.isin(r, s).any() for s in _seed_hashes()] for r in rows], float).reshape(
        len(rows), len(SEEDS)) * toxic[:, None]
    other = toxic * (seeded.sum(axis=1) == 0)
    folds = (mixed(ids.astype(np.uint64)) % np.uint64(FOLDS)).astype(int)
    chain, unseen = fit_chain(rows, np.column_stack((seeded, other, toxic)), folds)
    return chain, toxic, unseen


def scored(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
           threshold: float = THRESHOLD) -> DataFrame:
    """``key``, a probability for each category of the chain, and toxic_flag, for every document."""
    chain, _, _ = trained(docs, labels, key, text, label)
    source = docs.select(F.col(f"`{key}`"), F.col(f"`{text}`").cast("binary").alias("__text"))
    names = [f"p_{c}" for c in CATEGORIES]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column(1)):
                p = chain.probabilities(_features(chunk), chunk.n)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(chunk.first, chunk.n), *(pa.array(p[:, c]) for c in range(len(names))),
                     pa.array(p[:, -1] >= threshold)], names=[key, *names, "toxic_flag"])

    kind = source.schema[0].dataType.simpleString()
    return source.mapInArrow(run, f"`{key}` {kind}, " + ", ".join(f"{c} double" for c in names)
                             + ", toxic_flag boolean")

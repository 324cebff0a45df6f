"""Quality by weak supervision: rules vote or abstain, expectation-maximisation weighs them.

Every rule votes +1 (fit for training), -1 (unfit) or 0 (no opinion) on every document. Nobody labels anything: the
accuracies of the rules follow from how often they agree, by expectation-maximisation over a two-class model in which
rules err independently. The model sees documents only as vote patterns, at most ``3 ** len(RULES)`` of them with a
count each, so one aggregation over all documents is all it needs, however many there are.

Defined results: a null or empty text has no words and fails the base rules; equal rows get equal results; an empty
table gives an empty result. Extra columns are ignored by ``features`` and kept by ``judged``; a column of the input
that has the name of an added one is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waymark.llm.tables import written
from waymark.llm.text import Chunk, chunks, owners, per_document, shingles

#: Frequent function words of English, German, French and Spanish.
FUNCTION_WORDS = """
the of and to in is that for it as was with be by on are this at from or an not
der die das und in zu den von mit ist des sich auf für im dem nicht ein eine als
le la les de et des un une du en que est pour dans par sur au qui pas plus
el los las del y que un una por con para se su al lo como es no
""".split()

#: Long columns that one pass over the text gives.
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_letters",
          "n_capitals", "n_sentence_ends", "n_function_words"]

MIN_WORDS = 10
WINDOW = 5

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_CAPITAL = np.zeros(256, bool)
_CAPITAL[65:91] = True
_LETTER = _CAPITAL.copy()
_LETTER[97:123] = True
_LETTER[0xC3:0xF5] = True  # one letter for each multi-byte character
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".!?"]] = True


def _function_hashes() -> np.ndarray:
    column = pa.array(sorted(set(FUNCTION_WORDS)))
    (chunk,) = chunks(column)
    begin, end, _ = chunk.words()
    return np.sort(chunk.hashes(begin, end))


def _repeated(values: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which elements occur more than once in their group, and which of those are not the first."""
    order = np.lexsort((values, group))
    v, g = values[order], group[order]
    same = (v[1:] == v[:-1]) & (g[1:] == g[:-1])
    after = np.concatenate(([False], same))
    many = after | np.concatenate((same, [False]))
    again, later = np.zeros(len(v), bool), np.zeros(len(v), bool)
    again[order], later[order] = many, after
    return again, later


def _bytes_in(table: np.ndarray, data: np.ndarray, chunk: Chunk) -> np.ndarray:
    at = np.flatnonzero(table[data])
    return np.searchsorted(at, chunk.ends) - np.searchsorted(at, chunk.starts)


def counts_of(chunk: Chunk, known: np.ndarray) -> dict[str, np.ndarray]:
    """The columns COUNTS for the documents of a chunk."""
    data = chunk.data
    begin, end, bounds = chunk.words()
    words = chunk.hashes(begin, end)
    own = owners(bounds)
    wordlike = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=wordlike[1:])
    covered = np.zeros(len(words) + 1, np.int64)
    run, at = shingles(words, bounds, WINDOW)
    if len(run):
        hit = at[_repeated(run, own[at])[0]]
        np.add.at(covered, hit, 1)
        np.add.at(covered, hit + WINDOW, -1)
    line_begin, line_end, line_bounds = chunk.lines()
    line_own = owners(line_bounds)
    holds = np.searchsorted(begin, line_end) > np.searchsorted(begin, line_begin)
    lines = chunk.hashes(line_begin, line_end)
    later = np.zeros(len(lines), bool)
    at = np.flatnonzero(holds)
    later[at] = _repeated(lines[at], line_own[at])[1] if len(at) else False

    folded = chunk.lowered().hashes(begin, end)
    place = np.minimum(np.searchsorted(known, folded), len(known) - 1)
    return {
        "n_words": np.diff(bounds),
        "word_chars": per_document(wordlike[end] - wordlike[begin], bounds),
        "n_symbols": _bytes_in(_SYMBOL, data, chunk),
        "n_dup_lines": per_document(later, line_bounds),
        "n_repeat_words": per_document(np.cumsum(covered[:-1]) > 0, bounds),
        "n_lines": per_document(holds, line_bounds),
        "n_letters": _bytes_in(_LETTER, data, chunk),
        "n_capitals": _bytes_in(_CAPITAL, data, chunk),
        "n_sentence_ends": per_document(_STOP[data[end - 1]], bounds),
        "n_function_words": per_document(known[place] == folded, bounds),
    }


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known = _function_hashes()
    for batch in batches:
        keep = batch.schema.names[:-1]
        for chunk in chunks(batch.column(batch.num_columns - 1)):
            part = batch.slice(chunk.first, chunk.n)
            made = counts_of(chunk, known)
            yield pa.RecordBatch.from_arrays(
                [part.column(c) for c in range(len(keep))] + [pa.array(made[c], pa.int64()) for c in COUNTS],
                names=[*keep, *COUNTS])


@F.arrow_udf(T.StructType([T.StructField(c, T.LongType()) for c in COUNTS]))
def _counts_udf(texts: pa.Array) -> pa.Array:
    known = _function_hashes()
    made = [counts_of(chunk, known) for chunk in chunks(texts)]
    return pa.StructArray.from_arrays([pa.array(np.concatenate([m[c] for m in made]) if made else [], pa.int64())
                                       for c in COUNTS], COUNTS)


def features(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """The columns ``keep`` and COUNTS, one row per document, from one pass over the whole texts."""
    source = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").cast("binary").alias("__text"))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1]]
    return source.mapInArrow(_count_batches, ", ".join(fields + [f"{c} long" for c in COUNTS]))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def _vote(bad: Column, good: Column | None = None) -> Column:
    vote = F.when(bad, -1)
    return (vote if good is None else vote.when(good, 1)).otherwise(0)


def _rules() -> dict[str, Column]:
    """Signs of junk vote against or abstain: their absence says little. Signs of prose vote either way."""
    c = {name: F.col(name) for name in COUNTS}
    words, long_enough = c["n_words"], c["n_words"] >= 30
    return {
        "symbols": _vote(8 * c["n_symbols"] > words),
        "word_length": _vote((c["word_chars"] < 2 * words) | (c["word_chars"] > 14 * words)),
        "repeated_lines": _vote(3 * c["n_dup_lines"] > c["n_lines"]),
        "repeated_words": _vote(5 * c["n_repeat_words"] > words),
        "capitals": _vote(10 * c["n_capitals"] > 3 * c["n_letters"]),
        "sentences": _vote(long_enough & ((60 * c["n_sentence_ends"] < words)
                                          | (10 * c["n_sentence_ends"] > 8 * words)),
                           c["n_sentence_ends"].between(words / 50, words / 2) & (words > 0)),
        "function_words": _vote(long_enough & (50 * c["n_function_words"] < words),
                                10 * c["n_function_words"] >= words),
    }


RULES = ("symbols", "word_length", "repeated_lines", "repeated_words", "capitals", "sentences", "function_words")


def with_votes(counted: DataFrame) -> DataFrame:
    rules = _rules()
    return counted.withColumns({f"vote_{name}": rules[name].cast("tinyint") for name in RULES})


def fitted(votes: np.ndarray, counts: np.ndarray, rounds: int = 200) -> dict[str, np.ndarray | float]:
    """Prior of quality and, for each rule, its chance of each vote in either class, by expectation-maximisation.

    ``votes`` has a row per pattern. The start doubts what any rule votes against. Rules are held better than chance and
    every chance gets a pseudo count, so that classes can't swap and a vote never seen decides nothing.
    """
    m = votes.shape[1]
    share = counts / max(counts.sum(), 1)
    kinds = np.stack([votes == v for v in (-1, 0, 1)], axis=2).astype(float)  # pattern, rule, vote
    q = np.where((votes < 0).any(axis=1), 0.1, 0.9)
    prior, chance, ratio = 0.5, np.full((2, m, 3), 1 / 3), np.zeros((m, 3))
    for _ in range(rounds if len(q) else 0):
        prior = float(np.clip((share * q).sum(), 0.05, 0.95))
        for c, weight in ((0, share * (1 - q)), (1, share * q)):
            mass = np.einsum("p,pjv->jv", weight, kinds) + 1e-3
            chance[c] = mass / mass.sum(axis=1, keepdims=True)
        ratio = np.log(chance[1]) - np.log(chance[0])
        ratio[:, 0] = np.clip(ratio[:, 0], -4, 0)   # a vote against never speaks for a document
        ratio[:, 1] = 0                             # an abstention says nothing
        ratio[:, 2] = np.clip(ratio[:, 2], 0, 4)
        old, q = q, 1 / (1 + np.exp(-np.log(prior / (1 - prior)) - np.einsum("jv,pjv->p", ratio, kinds)))
        if np.abs(q - old).max() < 1e-9:
            break
    right = chance[1][:, 2] * prior + chance[0][:, 0] * (1 - prior)
    voting = 1 - chance[1][:, 1] * prior - chance[0][:, 1] * (1 - prior)
    return {"prior": prior, "ratio": ratio, "accuracy": right / np.maximum(voting, 1e-12)}


def judged(counted: DataFrame, threshold: float = 0.5, fit_on: DataFrame | None = None) -> DataFrame:
    """``counted`` with base_failed, posterior (of quality) and kept.

    Counts the vote patterns of all rows in one aggregation, fits the rules on them and scores every row with a sum
    of log odds. ``counted`` is read twice, so pass a written table if it is costly, or as ``fit_on`` the counts alone.
    """
    voted = with_votes(counted)
    names = [f"vote_{r}" for r in RULES]
    rows = (voted if fit_on is None else with_votes(fit_on)).groupBy(*names).count().collect()  # at most 3 ** len(RULES) rows
    votes = np.array([[r[c] for c in names] for r in rows], dtype=int).reshape(len(rows), len(names))
    model = fitted(votes, np.array([r["count"] for r in rows], dtype=float))
    odds = F.lit(float(np.log(model["prior"] / (1 - model["prior"]))))
    for j, name in enumerate(names):
        odds = odds + F.when(F.col(name) == 1, float(model["ratio"][j, 2])).when(
            F.col(name) == -1, float(model["ratio"][j, 0])).otherwise(0.0)
    posterior = 1 / (1 + F.exp(-odds))
    return voted.withColumns({"base_failed": base_failed(), "posterior": posterior}).withColumn(
        "kept", ~F.col("base_failed") & (F.col("posterior") >= threshold))


def quality(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = 0.5) -> DataFrame:
    """One row per document: ``key``, the counts, the votes, base_failed, posterior and kept."""
    return judged(written(features(docs, [key], text), "quality"), threshold)


def kept(docs: DataFrame, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that the rules keep, unchanged.

    Votes are counted in one pass and applied in another, so no text is shuffled or stored. Python sees the text
    alone and returns counts; the rows themselves stay where they are.
    """
    names = docs.columns
    plain = docs.select(*[F.col(f"`{c}`").alias(f"__c{k}") for k, c in enumerate(names)])
    own = f"__c{names.index(text)}"
    counted = plain.withColumn("__counts", _counts_udf(F.col(own).cast("binary"))).select(*plain.columns, "__counts.*")
    return judged(counted, threshold, features(plain, [], own)).where("kept").select(
        *[F.col(f"__c{k}").alias(c) for k, c in enumerate(names)])

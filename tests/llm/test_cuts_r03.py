"""Cases in which a bound once cut results: ties of distance, long documents in a mix, repeated labelled rows."""

import math

import numpy as np
import pytest

from waymark.llm import mixing, neighbours, toxicity


def test_equal_distances_go_to_smaller_ids(spark):
    rows = [(100, [0.001, 0.0, 0.0, 0.0])]
    for n in range(1, 41):  # forty vectors at one distance of the query, in scattered order of rows
        v = [0.001, 0.0, 0.0, 0.0]
        v[1 + n % 3] = 1.0 if n % 2 else -1.0
        rows.append((n, v))
    for n in range(41, 400):
        rows.append((n + 1000, [math.cos(n) * 3, math.sin(n) * 3, 1.0, 2.0]))
    data = spark.createDataFrame(rows[::-1], "vec_id long, embedding array<double>")
    got = neighbours.nearest(data, data.where("vec_id = 100"), shard_rows=64).orderBy("rank").collect()
    assert [r.vec_id for r in got] == list(range(1, 11))
    assert {r.score for r in got} == {1.0}


def test_distinct_vectors_at_one_distance():
    axes = np.vstack((np.eye(20), -np.eye(20)))
    order = np.random.default_rng(3).permutation(40)
    vectors, ids = axes[order], order + 1
    turn = np.random.default_rng(1).standard_normal((20, neighbours.PROJECTIONS))
    tree = neighbours.Tree(vectors @ turn)
    query = np.zeros(20)
    found = neighbours.search(tree, vectors, ids, query, query @ turn, 10, neighbours.stop_ratio(0.9999999))
    assert [i for _, i, _ in found] == list(range(1, 11))


@pytest.mark.parametrize("lengths, counts, budget, want", [
    ([140_000, 160_000], [1, 1], 150_000, 140_000),
    ([140_000, 160_000, 300_000], [1, 1, 1], 310_000, 300_000),
    ([100_003, 150_001, 170_007, 210_011], [1, 1, 1, 1], 380_020, 380_018),
    ([3, 500_000], [5, 2], 500_010, 500_009),
])
def test_long_documents_fit(lengths, counts, budget, want):
    lengths, counts = np.array(lengths), np.array(counts)
    taken = mixing.fit_lengths(lengths, counts, budget)
    assert (taken >= 0).all() and (taken <= counts).all()
    assert (taken * lengths).sum() == want


def test_sparse_sums_against_all_subsets():
    rng = np.random.default_rng(5)
    for _ in range(30):
        lengths = np.unique(rng.integers(1, 1_000_000, 8))
        counts = rng.integers(1, 3, len(lengths))
        budget = int(rng.integers(1, (lengths * counts).sum()))
        sums = {0}
        for n, c in zip(lengths.tolist(), counts.tolist(), strict=True):
            sums = {s + n * i for s in sums for i in range(c + 1)}
        taken = mixing.sparse_sum(lengths, counts, budget)
        assert (taken <= counts).all()
        assert (taken * lengths).sum() == max(s for s in sums if s <= budget)


def test_sparse_sums_of_many_long_documents():
    lengths = np.arange(100_000, 104_000, 2)
    counts = np.full(len(lengths), 3)
    budget = 123_456_789
    taken = mixing.sparse_sum(lengths, counts, budget)
    assert (taken <= counts).all()
    assert budget * 0.99 < (taken * lengths).sum() <= budget


def test_mix_reruns_agree_without_keys(spark):
    rows = [(None if n % 2 else 5, f"{'a b c d'[:1 + 2 * (n % 4)]} t{n}", "s", n) for n in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, extra int")
    runs = [sorted(map(str, mixing.applied(docs.repartition(n), budget=0.5).collect())) for n in (1, 7)]
    assert runs[0] == runs[1] and runs[0]


@pytest.mark.parametrize("hot_first", [True, False])
def test_repeated_labelled_rows_cost_no_others(spark, hot_first):
    hot, others = [(0, "the same text again")] * 9000, [
        (n, f"you idiot number w{n}" if n % 4 == 0 else f"a fine day number w{n}") for n in range(1, 301)]
    rows = hot + others if hot_first else others + hot
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    labels = spark.createDataFrame([(n, int(n % 4 == 0 and n > 0)) for n in range(301)] + [(0, 0), (4, 0)],
                                   "doc_id long, toxic int")
    ids, found, toxic = toxicity.labelled_rows(docs, labels)
    assert len(ids) == len(found) == 301 and toxic.sum() == 75


def test_labelled_bytes_are_bounded(spark):
    docs = spark.createDataFrame([(n, f"w{n} " * 100) for n in range(50)], "doc_id long, text string")
    labels = spark.createDataFrame([(n, n % 2) for n in range(50)], "doc_id long, toxic int")
    runs = [toxicity.labelled_rows(docs.repartition(n), labels, most_bytes=3000)[0].tolist() for n in (1, 5)]
    assert runs[0] == runs[1] and 0 < len(runs[0]) < 20


def test_mix_keeps_columns_of_any_name(spark):
    names = ["__source", "__size", "__key", "__draw", "__range", "__sid", "quota", "whole", "n"]
    docs = spark.createDataFrame([(n, f"a b t{n}", "s", *range(len(names))) for n in range(9)],
                                 ["doc_id", "text", "source", *names])
    got = mixing.mixed(docs, keep=names).collect()
    assert len(got) == 9 and all(tuple(r[c] for c in names) == tuple(range(len(names))) for r in got)

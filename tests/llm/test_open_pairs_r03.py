"""Near copies that no common leader settles: rows in proportion to them, and no link lost."""

import numpy as np
import pyarrow as pa
import pytest

from waymark.llm import ngram_join


def test_open_pairs_of_a_list_are_a_forest():
    m = 60
    columns = {"part": [7] * m, "side": [0] * m, "single": [True] * m, "sig": range(1, m + 1), "n": [100] * m,
               "pos": [0] * m, "comp": range(1, m + 1), "with_lead": [-1] * m, "lead_n": [100] * m}
    got = pa.Table.from_batches(ngram_join._open_batches(iter([pa.RecordBatch.from_pydict(
        {k: pa.array(list(v)) for k, v in columns.items()})])))
    assert got.num_rows == m - 1
    label = list(range(m + 1))
    for a, b in zip(got["a"].to_pylist(), got["b"].to_pylist(), strict=True):
        old = label[b]
        label = [label[a] if x == old else x for x in label]
    assert len(set(label[1:])) == 1


def brute_force(sets):
    """The smallest id reachable by pairs of similarity 0.8 or more."""
    label = {k: k for k in sets}
    for a in sets:
        for b in sets:
            if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]) and label[a] != label[b]:
                low, high = sorted((label[a], label[b]))
                label = {k: low if v == high else v for k, v in label.items()}
    return label


@pytest.mark.parametrize("block", [1024, 16])
def test_near_copies_about_the_threshold(spark, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "CLUSTER_BLOCK", block)
    rng = np.random.default_rng(4)
    base = [f"w{k}" for k in range(120)]
    texts = {}
    for doc in range(90):  # an end of its own each, and up to four words changed
        words = base[:int(rng.integers(96, 121))] + [f"e{doc}x{k}" for k in range(int(rng.integers(0, 8)))]
        for place in rng.integers(0, 90, int(rng.integers(0, 5))).tolist():
            words[place] = f"c{rng.integers(0, 3)}"
        texts[doc] = words
    want = brute_force({k: {tuple(w[i:i + 5]) for i in range(len(w) - 4)} for k, w in texts.items()})
    assert 1 < len(set(want.values())) < len(texts)
    docs = spark.createDataFrame([(k, " ".join(w)) for k, w in texts.items()], "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in ngram_join.joined(docs).collect()} == want

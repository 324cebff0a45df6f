"""Pairs that met by chance are settled without their sets, and what a query has used up is deleted."""

from pathlib import Path

import numpy as np
import pyarrow as pa

from waymark.llm import ngram_join
from waymark.llm.tables import shared_folder

SIZES = (1, 2, 63, 64, 65, 400, 500, 3000, 20000)


def sets(rng, sizes):
    run = [np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64)) for n in sizes]
    return run, np.concatenate(([0], np.cumsum([len(x) for x in run])))


def test_sketches_bound_what_sets_share():
    rng = np.random.default_rng(2)
    first, bounds = sets(rng, SIZES)
    near = [np.unique(np.concatenate((x[len(x) // 10:], x[:1] + np.uint64(1)))) for x in first]
    every = first + near
    bounds = np.concatenate(([0], np.cumsum([len(x) for x in every])))
    sketch = [np.frombuffer(x, np.uint64) for x in ngram_join.sketches(np.concatenate(every), bounds)]
    for a, x in zip(every, sketch, strict=True):
        for b, y in zip(every, sketch, strict=True):
            most = int(ngram_join.most_shared(len(a), len(b), x, y))
            assert len(np.intersect1d(a, b)) <= most <= (len(a) + len(b)) // 2
            if a is b:
                assert most == len(a)
    alike = ngram_join.most_shared(500, np.full(2, 500), sketch[6], np.stack((sketch[6], sketch[6][::-1])))
    assert alike[0] == 500 and alike[1] < ngram_join.shared_at_least(500, 500)


def test_members_that_share_one_shingle_are_not_open():
    m = 40
    run, bounds = sets(np.random.default_rng(3), [100] * m)
    run = [np.sort(np.append(x, np.uint64(5))) for x in run]
    run[7] = run[11]
    sketch = ngram_join.sketches(np.concatenate(run), np.concatenate(([0], np.cumsum([len(x) for x in run]))))
    columns = {"part": [7] * m, "side": [0] * m, "single": [True] * m, "sig": range(1, m + 1), "n": [101] * m,
               "pos": [0] * m, "comp": range(1, m + 1), "with_lead": [-1] * m, "lead_n": [101] * m, "sketch": sketch}
    got = pa.Table.from_batches(ngram_join._open_batches(iter([pa.RecordBatch.from_pydict(
        {k: pa.array(list(v)) for k, v in columns.items()})])))
    assert got.to_pylist() == [{"a": 8, "b": 12, "forced": False}]


def test_sets_are_written_for_near_pairs_alone_and_deleted(spark, monkeypatch):
    rng = np.random.default_rng(4)
    words = lambda n: " ".join(f"w{k}" for k in rng.integers(0, 100_000, n))
    texts = [f"five words that all have {words(60)}" for _ in range(200)]
    texts += [f"{texts[3]} more", f"{texts[3]} and", f"{texts[8]} more"]
    counted, plain = [], ngram_join.written

    def told(df, name, *rest):
        out = plain(df, name, *rest)
        if name == "sets":
            counted.append(out.count())
        return out

    monkeypatch.setattr(ngram_join, "written", told)
    folder = Path(shared_folder(spark).removeprefix("file:"))
    before = {p.name for p in folder.iterdir()}
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in ngram_join.joined(docs).collect()}
    assert got == {k: {200: 3, 201: 3, 202: 8}.get(k, k) for k in range(203)}
    assert counted and sum(counted) < 20
    assert {p.name.split("-")[0] for p in folder.iterdir() if p.name not in before} <= {"classes", "labels", "named"}
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"

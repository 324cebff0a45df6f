"""Language-model scores, collocations and ranked search against plain Python."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from waymark.llm import lm_scoring, phrase_mining, ranked_search

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
SCHEMA = "doc_id long, text string, lang string, source string"


def corpus(seed, n=120, words=60):
    rnd = random.Random(seed)
    vocabulary = [w + s for w in ("ab", "Cd", "é", "x1", "the", "Zz") for s in ("", "b", "ß", "C", "9", "'s")]
    rows = []
    for i in range(n):
        text = "".join(rnd.choice(vocabulary[:rnd.choice([5, 36])]) + rnd.choice([" "] * 8 + ["\t", ". ", "\n", ",", "  "])
                       for _ in range(rnd.randrange(words)))
        rows.append((i, text, rnd.choice(["en", "de", None]), "s"))
    rows += [(n, None, "en", None), (n + 1, "", None, "s"), (None, "the the ab", "und", "s"), (3, rows[3][1], "en", "s"),
             (n + 2, "the ab Cd " * 400, "en", "s"), (n + 3, "\n\n.,;", "de", "s")]
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).withColumnRenamed("source", "n").repartition(3)


def held_out(key):
    return key is not None and zlib.crc32(str(key).encode()) % 7 == 2


def words_and_end(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER)), None]


@pytest.mark.parametrize("order", [2, 3])
def test_scores(spark, order):
    rows = corpus(1)
    counts = Counter(w for key, text, *_ in rows if not held_out(key) for w in words_and_end(text))
    n, v = sum(counts.values()), len(counts)
    got = lm_scoring.scored(frame(spark, rows), order=order).collect()
    assert len(got) == len(rows)
    want = Counter()
    for key, text, *_ in rows:
        found = words_and_end(text)
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in found)
        want[(key, held_out(key), len(found), sum(counts[w] > 0 for w in found), n, f"{base:.6f}")] += 1
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, f"{r.base_score:.6f}") for r in got) == want
    assert all(r.score < 0 for r in got)
    long = next(r for r in got if r.doc_id == 122)
    assert long.held_out or long.score > long.base_score


def test_scores_are_the_same_where_the_model_is_not_broadcast(spark):
    docs = frame(spark, corpus(2))
    near = lm_scoring.scored(docs, part_bytes=2000).collect()
    far = lm_scoring.scored(docs, part_bytes=2000, broadcast_bytes=0).collect()
    assert sorted(map(str, near)) == sorted(map(str, far))


def test_model_predicts_held_out_text_better_than_words_alone(spark):
    rnd = random.Random(5)
    after = {k: [(7 * k + j) % 200 for j in range(4)] for k in range(200)}
    rows = []
    for i in range(400):
        w, text = rnd.randrange(200), []
        for _ in range(80):
            w = rnd.choice(after[w])
            text.append(f"w{w}")
        rows.append((i, " ".join(text), "en", "s"))
    got = [r for r in lm_scoring.scored(frame(spark, rows)).collect() if r.held_out]
    size = sum(r.n_tokens for r in got)
    assert sum(r.base_score for r in got) / size < -2.2
    assert abs(sum(r.score for r in got) / size + math.log10(4)) < 0.15  # the source's own entropy


def test_log_frequency_filter():
    rnd = np.random.default_rng(3)
    keys = np.unique(rnd.integers(1, 1 << 63, 20000).astype(np.uint64))
    counts = np.minimum(rnd.zipf(1.5, len(keys)), 1 << 40)
    table = lm_scoring.filter_of(keys, counts, 12)
    blocks = len(table) // 8
    levels = lambda k: lm_scoring.levels_in(table, lm_scoring._block(k, blocks) * 8, k)
    exact = np.floor(np.log2(counts)).astype(int) + 1
    assert (levels(keys) >= exact).all() and (levels(keys) == exact).mean() > 0.98
    other = np.setdiff1d(rnd.integers(1, 1 << 63, 20000).astype(np.uint64), keys)
    assert (levels(other) > 0).mean() < 0.02


def brute_phrases(rows, least, covered, top):
    f, n = defaultdict(Counter), Counter()
    for _, text, lang, _ in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(words)
            for k in (1, 2, 3):
                f[lang or "und"].update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        phrases = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in phrases.items():
            if any(100 * b >= covered * a for q, b in phrases.items() if len(q) > len(p) and p in (q[:2], q[1:])):
                continue
            score, k = min((10**6 * a * a // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        out += [(lang, i + 1, r[2].decode(), -r[1], r[3], r[4], n[lang], -r[0]) for i, r in enumerate(sorted(rows)[:top])]
    return sorted(out)


@pytest.mark.parametrize("burst,spill", [(1 << 16, 1 << 21), (4, 60), (1, 0)])
def test_collocations(spark, monkeypatch, burst, spill):
    monkeypatch.setattr(phrase_mining, "BURST", burst)
    monkeypatch.setattr(phrase_mining, "SPILL_WORDS", spill)
    rows = corpus(3)
    trie = phrase_mining.Node(3)
    want = Counter()
    ids = np.random.default_rng(burst).zipf(1.3, (300, 3)).clip(1, 9).astype(np.uint64)
    for batch in np.split(ids, 6):
        trie.insert([*batch.T, np.ones(len(batch), np.int64)])
        want.update(map(tuple, batch.tolist()))
    paths = trie.sorted()
    total = Counter()
    for *path, count in zip(*[c.tolist() for c in paths]):
        total[tuple(path)] += count
    assert total == want and list(zip(*[c.tolist() for c in paths[:3]])) == sorted(want)
    got = phrase_mining.collocations(frame(spark, rows), least=5, top=40, part_bytes=3000, spill=spill)
    assert sorted(map(tuple, got.collect())) == brute_phrases(rows, 5, 50, 40)


def test_empty_tables(spark):
    none = frame(spark, [])
    items = spark.createDataFrame([(1, "the ab")], "item_id long, text string")
    assert lm_scoring.scored(none).collect() == [] and phrase_mining.collocations(none).collect() == []
    assert ranked_search.ranked(none, items).collect() == []
    assert ranked_search.ranked(frame(spark, corpus(1, 5)), items.limit(0)).collect() == []


def brute_ranks(rows, items, k):
    terms = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    docs = [(key, Counter(found), len(found)) for key, text, *_ in rows if (found := terms(text))]
    n_docs, n_terms = len(docs), sum(n for *_, n in docs)
    df = Counter(t for _, tf, _ in docs for t in tf)
    w = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) for t in df}
    out = []
    for item, text in items:
        scores = []
        for key, tf, n in docs:
            m = 25 + (75 * n * n_docs) // n_terms
            score = sum(w[t] * ((10**9 * tf[t]) // (1000 * tf[t] + 8 * m)) for t in terms(text) if t in tf)
            if score > 0:
                scores.append((-score, key is None, key or 0, key))
        out += [(item, i + 1, s[3], -s[0]) for i, s in enumerate(sorted(scores)[:k])]
    return sorted(out, key=str)


@pytest.mark.parametrize("shard,postings", [(4096, 1_000_000), (7, 1_000_000), (50, 40)])
def test_ranked_search(spark, monkeypatch, shard, postings):
    monkeypatch.setattr(ranked_search, "BLOCK_BYTES", 30)
    rows = corpus(4) + [(200 + i, "copy of the abb", "en", "s") for i in range(30)]
    items = [(1, "the abb ab abb"), (2, None), (3, "nothing-here"), (4, "éß cd CD the"), (4, "copy of the"), (5, "x1 " * 9)]
    got = ranked_search.ranked(frame(spark, rows), spark.createDataFrame(items, "item_id long, text string"),
                                shard_docs=shard, shard_postings=postings)
    assert sorted(map(tuple, got.collect()), key=str) == brute_ranks(rows, items, 10)

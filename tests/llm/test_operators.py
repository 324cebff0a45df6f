"""The training-data operators against brute force, on rows with nulls, empty and long texts, ties and repeats."""

import base64
import hashlib
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from waymark.llm import (byte_bpe, license_scan, line_dedup, mixing, neighbours, ngram_join, quality_rules,
                         suffix_arrays, suffix_dedup, toxicity, warc)

WORD = re.compile(r"[^\x20\x09-\x0D]+")
PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
SCHEMA = "doc_id long, text string, source string, n_words string, size string"


def texts():
    draw = random.Random(5)
    words = ["the", "of", "Straße", "été", "alpha", "beta,", "GAMMA", "***", "x|y", "idiot", "日本", "🙂"]

    def prose(n):
        return "".join(draw.choice(words) + draw.choice([" ", " ", " ", "\n", "  "]) for _ in range(n))

    base, passage = prose(300), prose(60)
    rows = [base, base, base.replace("alpha", "delta", 2), prose(5000), "", None, " \n\t ", "a b", "A b", passage,
            prose(40) + "\n" + passage + "\n" + prose(40), prose(40) + "\n" + passage, "ab " * 200, "no end",
            prose(15) + "\n" + base]
    return rows + [prose(draw.randint(1, 80)) for _ in range(25)]


@pytest.fixture(scope="module")
def rows():
    out = [(k, t, None if k % 7 == 0 else f"s{k % 3}", "clash", "clash") for k, t in enumerate(texts())]
    return [*out, (None, "null key " * 8, "s0", None, None)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_quality_counts(docs, rows, empty):
    got = by_id(quality_rules.quality(docs))
    for key, text, *_ in rows:
        words = WORD.findall(text or "")
        runs = Counter(tuple(words[k:k + 5]) for k in range(len(words) - 4))
        covered = {k + j for k in range(len(words) - 4) if runs[tuple(words[k:k + 5])] > 1 for j in range(5)}
        lines = [x for x in (text or "").split("\n") if WORD.search(x)]
        want = (len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"),
                len(lines) - len(set(lines)), len(covered))
        r = got[key]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert not (r.kept and r.base_failed)
    assert quality_rules.quality(empty).count() == 0
    kept = quality_rules.kept(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {k for k, r in got.items() if r.kept}


def test_quality_model_finds_junk():
    draw = np.random.default_rng(1)
    good = draw.random(4000) < 0.8
    votes = np.stack([np.where(draw.random(4000) < 0.9, np.where(good, 1, -1), 0) * np.where(
        draw.random(4000) < 0.9, 1, -1) for _ in range(5)], axis=1)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    model = quality_rules.fitted(patterns, counts.astype(float))
    assert abs(model["prior"] - 0.8) < 0.05 and (model["accuracy"] > 0.8).all()
    assert quality_rules.fitted(np.zeros((0, 5), int), np.zeros(0))["prior"] == 0.5


def test_warc_round_trip(spark):
    long = "é" * 60
    data = [(3, "http://a.b/c d\r\nX: y", long), (1, None, long), (2, "https://h/p", "short"), (5, "u", "short"),
            (4, "x", None), (6, "y", "WARC/1.1\r\n\r\nWARC/1.1\r\n" * 9), (7, "z", long), (None, "n", "null id")]
    pages = spark.createDataFrame(data, "page_id long, url string, html string").repartition(2)
    got = {r.metadata.page_id: r for r in warc.round_trip(pages).collect()}
    assert set(got) == {r[0] for r in data}
    for key, _, html in data:
        body, r = (html or "").encode(), got[key]
        assert r.response.payload_digest == hashlib.sha256(body).hexdigest()
        assert r.metadata.payload_bytes == len(body)
        repeat = html == long and key != 1
        assert r.response.record_type == ("revisit" if repeat else "response")
        assert r.metadata.repeats_page == (1 if repeat else None)
        assert repeat or bytes(r.response.payload) == body
        assert r.request is not None and r.response.digest_valid in (True, None)
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_subset_sum_is_exact():
    draw = random.Random(2)
    for _ in range(200):
        lengths = np.array(draw.sample(range(1, 30), 4))
        counts = np.array([draw.randint(0, 4) for _ in lengths])
        budget = draw.randint(0, 150)
        reach = {0}
        for length, count in zip(lengths, counts):
            reach = {r + k * int(length) for r in reach for k in range(int(count) + 1)}
        taken = mixing.subset_sum(lengths, counts, budget)
        assert (taken <= counts).all()
        assert int((taken * lengths).sum()) == max(r for r in reach if r <= budget)


def test_mixing(docs, rows, empty):
    first, again = by_id(mixing.mixed(docs)), by_id(mixing.mixed(docs))
    assert first == again
    sizes, share = {}, {}
    for key, text, source, *_ in rows:
        n = len(WORD.findall(text or ""))
        assert first[key]["size"] == n
        sizes[source] = sizes.get(source, 0) + n
        share.setdefault(source, []).append(first[key])
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    capped = set()
    while True:
        rest = 1.5 * sum(sizes.values()) - sum(2 * sizes[s] for s in capped)
        level = rest / sum(weight[s] for s in order if s not in capped)
        over = {s for s in order if s not in capped and weight[s] * level > 2 * sizes[s]}
        if not over:
            break
        capped |= over
    for s in order:
        target = 2.0 * sizes[s] if s in capped else weight[s] * level
        assert share[s][0].target == pytest.approx(target)
        assert 0 <= target - sum(r.taken for r in share[s]) <= max(r["size"] for r in share[s])
        assert all(r.taken in (0, r["size"], 2 * r["size"]) for r in share[s])
    assert mixing.mixed(empty).count() == 0
    assert mixing.applied(docs).count() == sum(r.times for r in first.values())


def test_byte_bpe(docs, rows, empty):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    ids = byte_bpe.encoded(docs, PATH, public_tokenizers.PATTERN)
    got = by_id(byte_bpe.decoded(ids, PATH, public_tokenizers.PATTERN))
    assert got == by_id(byte_bpe.round_trip(docs, PATH, public_tokenizers.PATTERN))
    for key, text, *_ in rows:
        assert list(got[key].ids) == own.encode_ordinary(text or "")
        assert got[key].decoded == (text or "")
    assert byte_bpe.encoded(empty, PATH, public_tokenizers.PATTERN).count() == 0
    codec = byte_bpe.Codec(ranks, public_tokenizers.PATTERN)
    draw = random.Random(3)
    for _ in range(300):
        text = "".join(chr(draw.choice([draw.randint(32, 126), draw.randint(0x80, 0x7FF), 0x1F642, 0x20]))
                       for _ in range(40)) + "a" * draw.randint(0, 300)
        assert codec.encode(text) == own.encode_ordinary(text)
    for data in ("aé日🙂".encode(), b"\xff\xe6\x97a\xf0\x9f\x99", b"\xed\xa0\x80", bytes(range(256))):
        stream = byte_bpe.Utf8Stream()
        assert "".join([*(stream.feed(data[k:k + 1]) for k in range(len(data))), stream.close()]) == data.decode(
            "utf-8", "replace")


def test_ngram_join(docs, rows, empty):
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    sets = {}
    for key, text, *_ in rows:
        w = WORD.findall((text or "").translate(lower))
        sets[key] = {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}
    parent = {k: k for k in sets}
    keys = sorted(k for k in sets if k is not None)
    for _ in keys:
        for a in keys:
            for b in keys:
                if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    parent[a] = parent[b] = min(parent[a], parent[b])
    got = by_id(ngram_join.joined(docs))
    assert {k: got[k].component_id for k in keys} == {k: parent[k] for k in keys}
    assert {k: got[k].n_shingles for k in sets} == {k: len(s) for k, s in sets.items()}
    assert ngram_join.joined(empty).count() == 0
    stay = ngram_join.representatives(docs)
    assert stay.columns == docs.columns
    assert sorted(r.doc_id for r in stay.collect() if r.doc_id is not None) == sorted({parent[k] for k in keys})


def test_toxicity(spark, docs, empty):
    data = [(k, ("you idiot " if k % 8 == 0 else "worthless scum " if k % 8 == 1 else "") + f"word{k % 5} fine day")
            for k in range(400)]
    known = spark.createDataFrame([(k, int(k % 8 < 2)) for k in range(300)], "doc_id long, toxic int")
    got = by_id(toxicity.scored(spark.createDataFrame(data, "doc_id long, text string"), known))
    assert all(got[k].toxic_flag == (k % 8 < 2) for k in range(400))
    assert toxicity.scored(empty, known).count() == 0
    unlabelled = toxicity.scored(docs, known.limit(0)).collect()
    assert len(unlabelled) == docs.count() and not any(r.toxic_flag for r in unlabelled)


def test_suffix_array_and_prefixes():
    draw = random.Random(4)
    for _ in range(300):
        text = np.array([draw.randint(1, draw.choice([1, 2, 4])) for _ in range(draw.randint(1, 60))] + [0])
        order = suffix_arrays.suffix_array(text, 5)
        assert order.tolist() == sorted(range(len(text)), key=lambda k: list(text[k:]))
        shared = suffix_arrays.common_prefixes(text, order, 0)
        for a, b in zip(order, order[1:]):
            n = 0
            while max(a, b) + n < len(text) - 1 and text[a + n] == text[b + n]:
                n += 1
            assert shared[b] == n


def test_suffix_dedup(docs, rows, empty):
    got, seen = by_id(suffix_dedup.deduplicated(docs)), set()
    for key, text, *_ in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        data = (text or "").encode()
        gone = [False] * len(data)
        for s in range(len(data) - 99):
            if data[s:s + 100] in seen:
                gone[s:s + 100] = [True] * 100
            seen.add(data[s:s + 100])
        left = bytes(c for c, g in zip(data, gone) if not g)
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        r = got[key]
        assert (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) == (len(data), sum(gone), spans, left)
    assert suffix_dedup.deduplicated(empty).count() == 0


def test_license_scan(spark, empty):
    fill = "some words that say nothing of note about it and go on " * 20
    data = [(0, fill + "Released under the MIT License. " + fill), (1, fill), (2, None), (3, ""),
            (4, license_scan.TEMPLATES["MIT"][1].upper()), (5, license_scan.TEMPLATES["BSD-3-Clause"][0][:-50])]
    data += [(9 + k, "pad " * k + license_scan.TEMPLATES["Apache-2.0"][1] + " tail" * k) for k in range(30)]
    found = license_scan.matches(spark.createDataFrame(data, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.license) for r in found} == {(0, "MIT"), (4, "MIT")} | {(9 + k, "Apache-2.0") for k in range(
        30)}
    assert all(r.first_word == r.doc_id - 9 for r in found if r.doc_id >= 9)
    assert license_scan.matches(empty).count() == 0


def test_neighbours(spark):
    draw = np.random.default_rng(6)
    points = np.round(draw.standard_normal((600, 12)), 3)
    points[100:140] = points[7]
    data = [(k, p.tolist(), 0) for k, p in enumerate(points)]
    data += [(900, None, 0), (901, [0.0] * 12, 0), (902, [float("nan")] + [1.0] * 11, 0), (903, [1.0, None], 0)]
    table = spark.createDataFrame(data, "vec_id long, embedding array<double>, score int")
    found = neighbours.nearest(table, table.where("vec_id % 25 = 0 OR vec_id >= 900"), shard_rows=200).collect()
    hits = 0
    for q in range(0, 600, 25):
        away = np.sqrt(((points - points[q]) ** 2).sum(axis=1))
        best = [k for k in np.lexsort((np.arange(600), away)) if k != q][:10]
        own = sorted((r for r in found if r.query_id == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in own] == list(range(1, 11))
        assert all(r.score == pytest.approx(away[r.vec_id]) for r in own)
        hits += len({r.vec_id for r in own} & set(best))
    assert hits >= 0.9 * 240 and not any(r.query_id >= 900 or r.vec_id >= 900 for r in found)
    same = sorted((r for r in found if r.query_id == 100), key=lambda r: r["rank"])
    assert [r.vec_id for r in same] == [7, *range(101, 110)]
    assert neighbours.nearest(table.limit(0), table.limit(0)).count() == 0


def test_line_dedup(spark, docs, empty):
    block = ["one two three four five six seven eight", "nine ten eleven twelve thirteen", "a b c d e f g h i j k"]
    data = [(1, "\n".join(["intro x", *block, "end"])), (2, "\n".join(["other", *block, "tail"])),
            (3, "\n".join([block[1], "alone", block[0]])), (4, None), (5, ""), (None, "\n".join(block))]
    got = {r.doc_id: r.text for r in line_dedup.deduplicated(
        spark.createDataFrame(data, "doc_id long, text string")).collect()}
    assert got == {1: data[0][1], 2: "other\ntail", 3: data[2][1], 4: None, 5: "", None: ""}
    out = line_dedup.deduplicated(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    texts_of = by_id(out)
    assert texts_of[1].text.strip() == "" and texts_of[0].text == by_id(docs)[0].text
    assert line_dedup.deduplicated(empty).count() == 0


def test_patience_keeps_order():
    assert line_dedup.aligned([1, 2, 3, 9], [1, 8, 3, 2, 9]) in ([(0, 0), (1, 3), (3, 4)], [(0, 0), (2, 2), (3, 4)])
    assert line_dedup.aligned([5, 5, 5], [5, 5]) == [(0, 0), (1, 1)]

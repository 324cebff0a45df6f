"""What the second review found missing, against brute force."""

import random
from collections import Counter

from pyspark.sql import functions as F

from waymark.llm import license_scan, line_dedup, suffix_dedup

SCHEMA = "doc_id long, text string"


def without_blocks(texts, min_words=20):
    """Each text without the runs of ``min_words`` words or more that an earlier one has, by comparing all lines."""
    out = []
    for n, text in enumerate(texts):
        lines, gone = text.split("\n"), set()
        for earlier in (t.split("\n") for t in texts[:n]):
            for i in range(len(lines)):
                for j in range(len(earlier)):
                    k = 0
                    while i + k < len(lines) and j + k < len(earlier) and lines[i + k] == earlier[j + k]:
                        k += 1
                    if sum(len(x.split()) for x in lines[i:i + k]) >= min_words:
                        gone.update(range(i, i + k))
        out.append("\n".join(x for k, x in enumerate(lines) if k not in gone))
    return out


def lines_of(spark, texts):
    got = line_dedup.deduplicated(spark.createDataFrame(list(enumerate(texts)), SCHEMA).repartition(3)).collect()
    return [r.text for r in sorted(got, key=lambda r: r.doc_id)]


def test_line_dedup_repeated_and_crossed(spark):
    long = " ".join(f"w{k}" for k in range(30))
    other = " ".join(f"v{k}" for k in range(25))
    texts = [f"{long}\nx\n{long}\ny", f"z\n{long}\nw", f"a\n{long}\n{other}\nb", f"c\n{other}\nd\n{long}\n{long}\ne"]
    assert lines_of(spark, texts)[1:] == ["z\nw", f"a\n{other}\nb", "c\nd\ne"]


def test_line_dedup_blocks_of_short_lines(spark):
    a, b, c = (" ".join(f"{x}{k}" for k in range(8)) for x in "abc")
    texts = [f"{a}\n{b}", f"{b}\n{c}", f"p\n{a}\n{b}\n{c}\nq", f"r\n{a}\n{b}\n{c}\ns"]
    assert lines_of(spark, texts) == [*texts[:3], "r\ns"]


def test_line_dedup_equals_brute_force(spark):
    draw = random.Random(8)
    pool = ["", *(" ".join(f"{name}{k}" for k in range(size)) for name, size in
                  zip("abcdefghij", [1, 2, 4, 6, 7, 8, 9, 12, 19, 24]))]
    texts = ["\n".join(draw.choice(pool) for _ in range(draw.randint(1, 9))) for _ in range(60)]
    assert lines_of(spark, texts) == without_blocks(texts)


def bytes_left(texts):
    """Each text without the bytes of 100-byte strings that start earlier, in the order given."""
    seen, out = set(), []
    for text in texts:
        data = text.encode()
        gone = bytearray(len(data))
        for s in range(len(data) - 99):
            if data[s:s + 100] in seen:
                gone[s:s + 100] = b"x" * 100
            seen.add(data[s:s + 100])
        out.append(bytes(c for c, g in zip(data, gone) if not g))
    return out


def test_suffix_dedup_tells_null_keys_apart(spark):
    draw = random.Random(9)
    shared = "".join(draw.choice("abcdefgh ") for _ in range(150))
    rows = [(1, shared)] + [(None, f"{k:04d}" + "".join(draw.choice("ijklmnop ") for _ in range(110)) + (
        shared if k % 2 else "")) for k in range(4000)]
    rows += [(7, "q" + "".join(draw.choice("rstuvwxyz ") for _ in range(200)))] * 3
    rows += [(None, rows[5][1])] * 2
    docs = spark.createDataFrame(rows, SCHEMA)
    order = [(r.doc_id, r.text) for r in docs.distinct().orderBy(
        F.col("doc_id").asc_nulls_last(), F.xxhash64(F.col("text").cast("binary"), "doc_id")).collect()]
    left = dict(zip(order, bytes_left([text for _, text in order]), strict=True))
    got = suffix_dedup.deduplicated(docs.repartition(3)).collect()
    assert Counter((r.doc_id, bytes(r.kept)) for r in got) == Counter((r[0], left[r]) for r in rows)


def test_suffix_dedup_splits_hot_anchors(spark):
    draw = random.Random(10)
    shared = "".join(draw.choice("abcdefgh ") for _ in range(180))

    def prose(n):
        return "".join(draw.choice("ijk ") for _ in range(n))

    texts = [prose(draw.randint(0, 40)) + shared[draw.randint(0, 9):] + prose(draw.randint(0, 40)) for _ in range(300)]
    for shard_bytes in (1, 3000, 10 ** 9):
        docs = spark.createDataFrame(list(enumerate(texts)), SCHEMA).repartition(5)
        got = suffix_dedup.deduplicated(docs, shard_bytes=shard_bytes).collect()
        assert [bytes(r.kept) for r in sorted(got, key=lambda r: r.doc_id)] == bytes_left(texts)
        assert shard_bytes != 1 or not most_held(docs, shard_bytes)


def most_held(docs, shard_bytes):
    """Contexts that a shard of hot anchors would hold: none, as all have more than ``shard_bytes``."""
    texts = docs.select(F.col("doc_id").alias("doc"), F.lit(0).alias("sig"), F.col("text").cast("binary"),
                        F.expr("array(struct(7L AS h, 0L AS pos, 1 AS n, true AS hot))").alias("asked"))
    out = texts.where("length(text) >= 100").mapInArrow(
        suffix_dedup._context_batches(100), "h long, window long, doc long, sig long, pos long, n int, bytes binary")
    return out.where("bytes IS NOT NULL").count()


def test_license_scan_tells_siblings_apart(spark):
    line = "This work is licensed under the GNU {}, version {}."
    header = ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU {} as "
              "published by the Free Software Foundation, either version {} of the License, or (at your option) any "
              "later version.")
    gnu = [("GPL-2.0", "General Public License", "2"), ("GPL-3.0", "General Public License", "3"),
           ("LGPL-2.1", "Lesser General Public License", "2.1"), ("LGPL-3.0", "Lesser General Public License", "3"),
           ("AGPL-3.0", "Affero General Public License", "3")]
    notices = [({name}, form.format(title, version)) for name, title, version in gnu for form in (line, header)]
    notices += [
        ({"MPL-1.1"}, "This Source Code Form is subject to the terms of the Mozilla Public License, v. 1.1."),
        ({"MPL-2.0"}, "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
        ({"CC-BY-SA-4.0"}, "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
        ({"CC-BY-NC-SA-4.0"}, "Licensed under CC BY-NC-SA 4.0."), ({"CC-BY-NC-4.0"}, "Licensed under CC BY-NC 4.0."),
        ({"GPL-2.0", "GPL-3.0"}, header.format(gnu[0][1], 2) + " " + header.format(gnu[1][1], 3)),
        ({"BSD-2-Clause"}, license_scan.TEMPLATES["BSD-2-Clause"][0]), (set(), header.format(gnu[0][1], 1))]
    docs = spark.createDataFrame([(k, "some words before. " + n + " And after it.") for k, (_, n) in enumerate(notices)],
                                 SCHEMA)
    got = license_scan.matches(docs).collect()
    assert [{r.license for r in got if r.doc_id == k} for k in range(len(notices))] == [want for want, _ in notices]

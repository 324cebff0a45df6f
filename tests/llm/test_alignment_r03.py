"""Line dedup deletes by alignment alone, and whatever both documents hold."""

import random

from waymark.llm import line_dedup


def hash_of(n):
    return random.Random(n).randrange(1 << 62)


def brute(later, sizes, earlier, min_words):
    gone = set()
    for i in range(len(later)):
        for j in range(len(earlier)):
            n = 0
            while i + n < len(later) and j + n < len(earlier) and later[i + n] == earlier[j + n]:
                n += 1
            if sum(sizes[i:i + n]) >= min_words:
                gone.update(range(i, i + n))
    return sorted(gone)


def cases(seed=5, n=1500):
    rng = random.Random(seed)
    for _ in range(n):
        kinds = rng.choice([3, 6, 30])
        names = [rng.randrange(1, 1 << 62) for _ in range(kinds)]
        size = {x: rng.choice([0, 3, 8, 25]) for x in names}
        later, earlier = ([rng.choice(names) for _ in range(rng.randrange(1, 25))] for _ in range(2))
        if rng.random() < 0.6:
            at, n = rng.randrange(len(earlier)), rng.randrange(1, 9)
            for _ in range(rng.randrange(1, 4)):
                place = rng.randrange(len(later) + 1)
                later[place:place] = earlier[at:at + n]
        yield later, [size[x] for x in later], earlier


def test_common_blocks_equal_brute_force():
    for later, sizes, earlier in cases():
        assert line_dedup.common_blocks(later, sizes, earlier, 20) == brute(later, sizes, earlier, 20)


def test_nothing_is_deleted_without_an_alignment(monkeypatch):
    monkeypatch.setattr(line_dedup, "aligned", lambda later, earlier: [])
    assert not any(line_dedup.common_blocks(*case, 20) for case in cases(n=200))


def test_a_passage_repeated_very_often_ends_soon():
    passage = [hash_of(n) for n in range(10)]
    later = passage * 400
    assert line_dedup.common_blocks(later, [5] * len(later), [hash_of(99), *passage, hash_of(98)], 20) == list(range(len(later)))
    back = [x for n in reversed(range(300)) for x in (hash_of(n), hash_of(1000 + n))]
    earlier = [x for n in range(300) for x in (hash_of(n), hash_of(1000 + n))]
    assert line_dedup.common_blocks(back, [10] * 600, earlier, 20) == list(range(600))

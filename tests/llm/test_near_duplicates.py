"""SimHash, sketches and components against brute force."""

import random
from hashlib import sha256

import numpy as np
import pytest
import xxhash

from carelens.llm import components, hashing, simhash, sketches


def brute_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text).encode()
    for space in b"\t\n\x0b\x0c\r":
        words = words.replace(bytes([space]), b" ")
    words = [w for w in words.split(b" ") if w]
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    values = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in values) > len(values)) if values else 0


def brute_components(pairs):
    """Smallest id reachable, by (id, fingerprint)."""
    label = {i: i for i, _ in pairs}
    changed = True
    while changed:
        changed = False
        for i, a in pairs:
            for j, b in pairs:
                if (a ^ b).bit_count() <= 3 and label[j] < label[i]:
                    label[i], changed = label[j], True
    return label


def texts(n, seed=1):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdeé") for _ in range(5)) for _ in range(200)]
    out = []
    while len(out) < n:
        base = [rng.choice(vocabulary) for _ in range(rng.choice((1, 2, 3, 40, 120)))]
        for _ in range(rng.randint(1, 4)):
            copy = list(base)
            if len(copy) > 30 and rng.random() < 0.6:
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            out.append(rng.choice((" ", "\n", " \t")).join(copy))
    return out[:n]


@pytest.mark.parametrize("split_above", [4096, 1])
def test_classes_equal_brute_force(spark, documents, split_above):
    rows = list(enumerate(texts(150))) + [(900, None), (901, ""), (902, " \n"), (903, "Ä A\x0bB\x0cc D")]
    got = {r.doc_id: r for r in simhash.near_duplicates(documents(rows), split_above=split_above).collect()}
    prints = [(i, brute_fingerprint(t or "")) for i, t in rows]
    assert {i: got[i].fingerprint for i in got} == {i: f"{f:016x}" for i, f in prints}
    assert {i: got[i].component_id for i in got} == brute_components(prints)


@pytest.mark.parametrize("thresholds", [(0, 0, 0, 0), (1, -1, 1, -1), (2, -1, 0, -1), (3, -1, -1, -1)])
def test_links_are_whole_for_every_allocation(spark, thresholds):
    rng = random.Random(6)
    base = [rng.getrandbits(64) for _ in range(30)]
    prints = sorted({b ^ sum(1 << rng.randrange(64) for _ in range(rng.randint(0, 4))) & (1 << 64) - 1 for b in base for _ in range(6)})
    groups = [simhash.Group(tuple(range(16 * i, 16 * i + 16)), t) for i, t in enumerate(thresholds) if t >= 0]
    df = spark.createDataFrame([(simhash._signed(p),) for p in prints], "fp long")
    expected = {frozenset((a, b)) for a in prints for b in prints if a != b and (a ^ b).bit_count() <= 3}
    for split in (4096, 2):
        got = {frozenset((r.a % (1 << 64), r.b % (1 << 64))) for r in simhash.links(df, groups, split_above=split).collect()}
        assert got == expected


def test_allocation_is_the_cheapest():
    pairs = [np.array([9.0, 5, 1, 0, 0]), np.array([100.0, 50, 3, 2, 1]), np.array([2.0, 4, 8, 1, 1])]
    cost, thresholds = simhash.allocate([4, 4, 4], pairs, 10, 3)
    assert sum(t + 1 for t in thresholds) == 4
    from itertools import product
    from math import comb

    def price(ts):
        return sum(simhash.PROBE_COST * 10 * (1 + sum(comb(4, k) for k in range(t + 1))) + pairs[i][: t + 1].sum() for i, t in enumerate(ts) if t >= 0)

    assert cost == min(price(ts) for ts in product(range(-1, 5), repeat=3) if sum(t + 1 for t in ts) == 4)


def test_distance_counts_are_exact(spark):
    rng = random.Random(9)
    prints = [rng.getrandbits(64) for _ in range(60)]
    groups = [list(range(i, 64, 4)) for i in range(4)]
    df = spark.createDataFrame([(simhash._signed(p),) for p in prints], "fp long")
    for bits, counts in zip(groups, simhash.distance_counts(df, groups)):
        mask = sum(1 << b for b in bits)
        expected = np.bincount([((a ^ b) & mask).bit_count() for a in prints for b in prints], minlength=17)
        assert np.allclose(counts, expected)


def test_keep_one(spark, documents):
    a, b = "one two three four five " * 20, "six seven eight nine ten " * 20
    rows = [(3, a), (1, a), (2, b), (2, b), (2, b + "x"), (None, "lone text here"), (None, "lone text here"), (None, a), (7, None), (8, "")]
    df = documents(rows)
    out = simhash.keep_one(df)
    assert out.columns == df.columns
    kept = sorted((r.doc_id or 0, r.text) for r in out.collect())
    assert [k for k, _ in kept] == [0, 1, 2, 7]
    assert simhash.keep_one(documents([])).collect() == []


def test_components_of_a_long_path(spark):
    edges = [(i, i + 1) for i in range(200)] + [(500, 501), (501, 500), (600, 600)]
    got = dict(components.components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {**dict.fromkeys(range(201), 0), 500: 500, 501: 500}


def brute_words(text):
    return [w for w in text.encode().lower().split() if w]


def test_word_hashes_tell_words_apart():
    data = "The the THE of\tthe\n\nof émile".encode()
    at, hashes = hashing.words(data, hashing.BY_SPACE)
    words = brute_words(data.decode())
    assert [data[a : a + len(w)].lower() for a, w in zip(at, words)] == words
    assert len(set(hashes.tolist())) == len(set(words)) and len(hashes) == len(words)
    long = ("word%d " * 3) % (1, 2, 3) * 60_000
    _, far = hashing.words(long.encode(), hashing.BY_SPACE)
    assert far.tolist() == hashing.words(b"word1 word2 word3", hashing.BY_SPACE)[1].tolist() * 60_000


def test_sketches_merge_and_estimate():
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(6000)]
    one, two = " ".join(words[:4000]).encode(), " ".join(words[2000:]).encode()
    a, b = sketches.sketch_many([one, two])
    assert np.array_equal(sketches.merge(a, b), sketches.smallest(np.concatenate((a, b)), sketches.K))
    assert abs(sketches.resemblance(a, b) - 1 / 3) < 0.13
    assert abs(sketches.containment(a, b) - 0.5) < 0.2
    assert abs(sketches.distinct_shingles(a) / 3996 - 1) < 0.3
    assert np.array_equal(sketches.from_text(sketches.to_text(a)), a)
    exact = sketches.sketch_many([b"a b c d e f", b"a b c d e", b"", b"a", b"a b c d e f a b c d e"])
    assert [len(s) for s in exact] == [2, 1, 0, 1, 7 - 1]
    assert sketches.resemblance(exact[2], exact[2]) == 1.0 and sketches.resemblance(exact[2], exact[3]) == 0.0


@pytest.mark.parametrize("partitions", ["1", "8", "40"])
def test_edited_copies_equal_brute_force(spark, documents, partitions):
    rows = [(i * 3 % 97, t) for i, t in enumerate(texts(90, seed=3))] + [(1000, None), (1001, ""), (-5, "ÄÖ é日本 words " * 300), (None, "last of all here now"), (40_000, "x")]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = {r.doc_id: r for r in sketches.edited_copies(documents(rows)).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    ordered = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0)))
    assert len(got) == len(ordered)
    for (i, text), (_, following) in zip(ordered, ordered[1:] + ordered[:1]):
        n = len(text) // 3
        edited = text[: len(text) - n] + following[:n]
        own, other, after = sketches.sketch_many([text.encode(), edited.encode(), following.encode()])
        row = got[i]
        assert row.n_chars == len(text) and row.edited_sha256 == sha256(edited.encode()).hexdigest()
        assert row.fingerprint == sketches.to_text(own) and row.edited_fingerprint == sketches.to_text(other)
        assert (row.near_edited, row.near_next) == (sketches.resemblance(own, other), sketches.resemblance(own, after))


def test_edited_copies_of_repeated_and_missing_rows(spark, documents):
    rows = [(1, "same text of five words")] * 5 + [(None, None)] * 5
    got = sketches.edited_copies(documents(rows)).collect()
    assert len(got) == 10 and len({r.fingerprint for r in got}) == 2
    assert sketches.edited_copies(documents([])).collect() == []
    assert sketches.sketches(documents(rows)).count() == 10

"""Spelling variants against brute force and SQL."""

import random
from collections import Counter
from itertools import combinations
from zlib import crc32

import duckdb
import pytest

import __spark_entry__ as registry
from carelens.llm import spelling
from carelens.session import materialise


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(counts):
    """{word: (n, n_near, form, form_n, root)} by comparing all pairs."""
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w, others in near.items():
        top = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = top if top is not None and counts[top] >= 2 * counts[w] else None
    out = {}
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (counts[w], len(near[w]), form[w], None if form[w] is None else counts[form[w]], root)
    return out


def grouped(df):
    return {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in df.select("word", "n", "n_near", "form", "form_n", "root").collect()}


def some_words(seed, n, letters):
    rng = random.Random(seed)
    out = {"".join(rng.choice(letters) for _ in range(rng.randint(4, 8))) for _ in range(n)}
    for w in rng.sample(sorted(out), n // 3):
        i = rng.randrange(len(w))
        out.add(rng.choice([w[:i] + w[i + 1 :] + "q", w[:i] + rng.choice(letters) + w[i:], w[:i] + rng.choice(letters) + w[i + 1 :]]))
    return {w: rng.choice([1, 2, 3, 5, 8, 20, 100]) for w in out}


def test_pivots_are_the_cheapest_disjoint_grams():
    rng = random.Random(1)
    for _ in range(300):
        places = sorted(rng.sample(range(9), rng.randint(3, 7)))
        weights = [rng.randint(1, 9) for _ in places]
        cost = dict(zip(places, weights))
        got = spelling.pivots(places, weights)
        options = [c for c in combinations(places, 2) if c[1] - c[0] >= 2]
        assert got[1] - got[0] >= 2 and sum(map(cost.get, got)) == min(sum(map(cost.get, c)) for c in options)
    assert spelling.pivots([0, 1, 5, 6, 9], [1, 1, 1, 1, 1], count=3, gram=3) == [0, 5, 9]


@pytest.mark.parametrize("letters", ["ab", "abcdeé", "abcdefghijklmnopqrstuvwxyz"])
def test_groups_equal_brute_force(spark, letters):
    counts = some_words(2, 400, letters) | {"x" * 3000: 4, "x" * 2999: 9, "abab" * 5: 1, "abab" * 5 + "a": 2}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert grouped(spelling.group_variants(df)) == brute(counts)


def test_many_words_share_their_rare_grams(spark):
    counts = {f"zq{a}{b}{c}": 1 + (a == "a") * 5 for a in "abcdefghij" for b in "abcdefghij" for c in "abcd"}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert grouped(spelling.group_variants(df)) == brute(counts)


def test_roots_follow_long_chains(spark):
    counts = {"a" * i + "bcdef": 2**i for i in range(20)}
    got = grouped(spelling.group_variants(spark.createDataFrame(list(counts.items()), "word string, n long")))
    assert got == brute(counts) and {v[-1] for v in got.values()} == {"a" * 19 + "bcdef"}


def test_no_join_broadcasts_words(spark, monkeypatch):
    plans = []

    def written(df, label):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return materialise(df, label)

    monkeypatch.setattr(spelling, "materialise", written)
    got = spelling.group_variants(spark.createDataFrame([("abcdef", 9), ("abcdeg", 2), ("bcdeg", 1)], "word string, n long"))
    plans.append(got._jdf.queryExecution().executedPlan().toString())
    joins = [plan for plan in plans if "Join" in plan]
    assert len(joins) >= 4 and not any("Broadcast" in plan for plan in joins)  # keys, counts, roots, result
    assert grouped(got) == brute({"abcdef": 9, "abcdeg": 2, "bcdeg": 1})


def test_words_of_texts(documents, rows):
    texts = [(i, "Straße straße STRASSE Ångström's ångström ×÷× o'clock x_y Wörter2Wörter " * 9) for i in range(60)]
    texts += [(7, None), (8, ""), (None, "nullid " * 50), (3, "the the THE theory theory Theory"), (3, "theory")]
    expected = Counter()
    for key, text in texts:
        run = ""
        for c in (text or "") + " ":
            if c.isascii() and c.isalpha() or "À" <= c <= "ÿ":
                run += c.lower() if c.isascii() else c
                continue
            if run:
                h = crc32(f"{'' if key is None else key}:{run}".encode())
                at = h % len(run)
                expected[run[:at] + run[at + 1 :] if h % 5 == 0 else run] += 1
            run = ""
    got = rows(spelling.words(documents(texts), every=5))
    assert got == sorted((w, n) for w, n in expected.items() if len(w) >= 5 and n >= 3) and got


def test_empty_tables(spark, documents):
    assert spelling.words(documents([])).collect() == []
    assert spelling.group_variants(spelling.words(documents([(1, None), (None, "")]))).collect() == []


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01"])
def test_registered_query_equals_sql(spark, scale):
    sf = f"/root/testdata/{scale}"
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    result = db.execute(registry.oracle_sql()["op11_spelling_variants"])
    columns = [d[0] for d in result.description]
    got = registry.queries()["op11_spelling_variants"](spark, sf).select(*columns).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, result.fetchall()))

"""Suffix-array deduplication against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from carelens.llm import suffix_dedup


def brute(rows, limit, keep="none"):
    """{(doc_id, text): (kept, removed runs)} by every string of every text; rows in order of id, nulls last."""
    data = [(i, t, (t or "").encode()) for i, t in sorted(rows, key=lambda r: (r[0] is None, r[0], r[1] or ""))]
    count, seen, out = Counter(b[i : i + limit] for _, _, b in data for i in range(len(b) - limit + 1)), set(), {}
    for doc_id, text, b in data:
        gone = np.zeros(len(b) + 2, bool)
        for i in range(len(b) - limit + 1):
            string = b[i : i + limit]
            if count[string] > 1 if keep == "none" else string in seen:
                gone[i + 1 : i + 1 + limit] = True
            seen.add(string)
        step = np.diff(gone.astype(int))
        kept = bytes(np.frombuffer(b, np.uint8)[~gone[1:-1]])
        out[doc_id, text] = (kept, list(zip(np.flatnonzero(step == 1).tolist(), np.flatnonzero(step == -1).tolist())))
    return out


def found(df, limit, **options):
    out = suffix_dedup.remove_repeats(df, limit, **options)
    return {(r.doc_id, r.text): (bytes(r[-2]), [tuple(s) for s in r[-1] or []]) for r in out.collect()}


def test_factors_equal_brute_force():
    rng = random.Random(1)
    for _ in range(200):
        limit, text = rng.randint(1, 6), bytes(rng.choice(b"ab") for _ in range(rng.randint(6, 60)))
        starts = np.array(sorted(rng.sample(range(len(text) - limit + 1), rng.randint(1, len(text) - limit + 1))))

        def common(i, j):
            return next((k for k in range(limit) if text[i + k] != text[j + k]), limit)

        before, after = suffix_dedup.factors(np.frombuffer(text, np.uint8), starts, limit)
        assert before.tolist() == [max((common(i, j) for j in starts if j < i), default=0) for i in starts]
        assert after.tolist() == [max((common(i, j) for j in starts if j > i), default=0) for i in starts]


def test_starts_of_equal_strings_have_equal_anchors():
    rng = random.Random(2)
    shared = bytes(rng.choice(b"abc ") for _ in range(400))
    texts = [shared, b"x" * 37 + shared + b"yz", bytes(rng.choice(b"abc ") for _ in range(900)) + shared[100:350], b"a" * 700, b"", b"short"]
    anchor = {}
    for row, start, size, h, _ in suffix_dedup.segments(texts, 200, 96):
        for r, a, n, key in zip(row, start, size, h):
            for i in range(a, a + n):
                assert anchor.setdefault(texts[r][i : i + 200], key) == key
    assert set(anchor) == {t[i : i + 200] for t in texts for i in range(len(t) - 199)}


def test_long_texts_in_pieces_are_the_same(monkeypatch):
    rng = random.Random(3)
    texts = [bytes(rng.choice(b"ab") for _ in range(3000))]
    whole = [tuple(x) for part in suffix_dedup.segments(texts, 40, 12) for x in zip(*part)]
    monkeypatch.setattr(suffix_dedup, "PIECE", 256)
    pieces = [tuple(x) for part in suffix_dedup.segments(texts, 40, 12) for x in zip(*part)]
    expand = lambda rows: {(start + i, h) for _, start, size, h, _ in rows for i in range(size)}
    assert expand(whole) == expand(pieces) and len(pieces) > len(whole)


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abé") for _ in range(rng.randint(1, 4)))
    passage = [" ".join(word() for _ in range(12)) for _ in range(4)]
    texts = []
    for _ in range(40):
        parts = [" ".join(word() for _ in range(rng.randint(0, 12))) for _ in range(3)]
        texts.append(rng.choice(passage).join(parts) if rng.random() < 0.7 else " ".join(parts))
    texts += [texts[0]] * 5 + ["ab" * 60, "a" * 100, "", "ab", None, None]
    return list(enumerate(texts)) + [(None, texts[1]), (3, texts[3])]


@pytest.mark.parametrize("keep", ["none", "first"])
@pytest.mark.parametrize("many", [suffix_dedup.MANY, 1])
def test_operator_equals_brute_force(documents, keep, many):
    rows = corpus(4) if keep == "none" else corpus(4)[:-1]
    assert found(documents(rows), 24, keep=keep, many=many) == brute(rows, 24, keep)


def test_equal_rows_are_one_document_when_the_first_copy_stays(documents):
    rng = random.Random(5)
    text = "".join(rng.choice("abc") for _ in range(80))
    got = found(documents([(1, text), (1, text), (2, text)]), 20, keep="first")
    assert got == {(1, text): (text.encode(), []), (2, text): (b"", [(0, 80)])}


def test_one_passage_in_a_third_of_the_rows(documents):
    rng = random.Random(6)
    passage = "".join(rng.choice("abcdefgh") for _ in range(60))
    rows = [(i, "".join(rng.choice("abcdefgh") for _ in range(90)) + (passage if i % 3 == 0 else "") + f" {i}") for i in range(300)]
    assert found(documents(rows), 50, many=16) == brute(rows, 50)


def test_columns_stay_and_an_empty_table_is_empty(documents):
    df = documents([(1, "x" * 300)]).withColumn("kept", F.lit(7))
    out = suffix_dedup.remove_repeats(df)
    assert out.columns == [*df.columns, "_kept", "_removed"]
    row = out.first()
    assert row.kept == 7 and bytes(row["_kept"]) == b"" and [tuple(s) for s in row["_removed"]] == [(0, 300)]
    assert suffix_dedup.remove_repeats(df.limit(0)).collect() == []


def test_registered_query_equals_brute_force(spark, sf):
    got = {r.doc_id: tuple(r)[1:] for r in registry.queries()["op12_suffix_dedup"](spark, sf).collect()}
    expected = {}
    for (doc_id, text), (kept, spans) in brute([(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()], 200).items():
        n = len((text or "").encode())
        expected[doc_id] = (n, n - len(kept), len(spans), hashlib.sha256(kept).hexdigest())
    assert got == expected

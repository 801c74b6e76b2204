"""Resampling, line deduplication, decontamination and toxicity against brute force and held-out labels."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from carelens.llm import decontaminate, importance, line_dedup, toxicity


@pytest.fixture(scope="module")
def tables(spark):
    read = lambda t: spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet")
    return {t: read(t) for t in ("documents", "labels", "benchmark")}


# importance resampling


def test_kth_largest_is_exact(spark):
    rng = random.Random(1)
    values = [rng.choice((rng.gauss(0, 1), 1e9 * rng.random(), 3.5, -2.0)) for _ in range(500)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    ordered = sorted(values, reverse=True)
    for k in (1, 2, 77, 250, 499, 500):
        assert importance.kth_largest(df, "x", k, bins=16) == ordered[k - 1]
    assert importance.kth_largest(df, "x", 900) == ordered[-1]
    assert importance.kth_largest(df, "x", 0) is None and importance.kth_largest(df.limit(0), "x", 3) is None


def test_counts_and_weights_equal_a_plain_model(spark):
    texts = ["a b a b c", "b b b!!", "", "c d É d"]
    good = [1, 0, 1, None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    sample = spark.createDataFrame([(i, g) for i, g in enumerate(good) if g is not None], "doc_id long, good int")
    buckets = 1 << 10
    model = importance.fit(df, sample, buckets)
    raw, target = np.zeros(buckets), np.zeros(buckets)
    for text, g in zip(texts, good):
        _, bucket = importance.features([text.encode()], buckets)
        np.add.at(raw, bucket, 1)
        if g == 1:
            np.add.at(target, bucket, 1)
    expected = np.log((target + 1) / (target.sum() + buckets)) - np.log((raw + 1) / (raw.sum() + buckets))
    assert np.allclose(model.log_ratio, expected)
    sums, counts = model.sums([t.encode() for t in texts])
    assert counts.tolist() == [5 + 4, 4 + 3, 0, 4 + 3]  # words and signs, then pairs
    assert np.isclose(sums[0], expected[importance.features([texts[0].encode()], buckets)[1]].sum())


def test_features_of_a_text_do_not_depend_on_its_neighbours():
    texts = [b"one two two", b"", b"three", b"one two two"]
    text, bucket = importance.features(texts)
    own = [sorted(bucket[text == i].tolist()) for i in range(4)]
    assert own[0] == own[3] == sorted(importance.features([texts[0]])[1].tolist()) and own[1] == []
    repeat = importance.features([b"x x"])[1][-1]
    assert repeat == importance.features([b"yy yy"])[1][-1]


def test_held_out_quality(tables):
    labels = tables["labels"]
    got = importance.classify(tables["documents"], labels.filter("doc_id % 2 = 0"))
    rows = got.join(labels.filter("doc_id % 2 = 1"), "doc_id").select("kept", "quality").collect()
    good = [r.kept for r in rows if r.quality == 1]
    bad = [r.kept for r in rows if r.quality == 0]
    assert np.mean(good) > 0.97 and np.mean(bad) < 0.1


def test_filter_keeps_what_the_classifier_keeps(tables):
    docs = tables["documents"].withColumn("scores", F.lit(1)).withColumn("log_ratio", F.lit("x"))
    kept = {r.doc_id for r in importance.classify(docs, tables["labels"]).filter("kept").collect()}
    out = importance.keep_good(docs, tables["labels"])
    assert out.columns == docs.columns and {r.doc_id for r in out.select("doc_id").collect()} == kept


def test_gumbel_top_k_draws_by_weight(spark, documents):
    n = 600
    df = documents([(i, "good words here" if i % 2 else "bad!! bad!!") for i in range(n)])
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(n)], "doc_id long, quality int, toxic int")
    drawn = importance.resample(df.select("doc_id", "text"), labels, k=100)
    keys = sorted((r.key for r in drawn.scored.collect()), reverse=True)
    assert drawn.cutoff == keys[99]


def test_noisy_keys_draw_in_proportion_to_the_weights(spark):
    """The exponential race: of weights 3, 2 and 1 the first key is the largest in three of six draws, and so on."""
    ids = spark.range(60_000).withColumn("weight", 3 - F.col("id") % 3)
    key = F.log("weight") + importance.gumbel(F.col("id"), F.xxhash64(F.col("id").cast("string")))
    race = ids.withColumn("key", key).groupBy((F.col("id") / 3).cast("long").alias("race")).agg(F.max_by("weight", "key").alias("first"), F.min_by("weight", "key").alias("last"))
    share = {r["first"]: r["n"] / 20_000 for r in race.groupBy("first").agg(F.count("race").alias("n")).collect()}
    assert all(abs(share[w] - w / 6) < 0.015 for w in (1, 2, 3))
    last = {r["last"]: r["n"] / 20_000 for r in race.groupBy("last").agg(F.count("race").alias("n")).collect()}
    assert abs(last[3] - (2 / 6 * 1 / 4 + 1 / 6 * 2 / 5)) < 0.015  # after 2 comes 1, or after 1 comes 2


def test_resampling_of_odd_rows(spark, documents):
    labels = spark.createDataFrame([(1, 1, 0), (None, 0, 0), (2, None, 0), (3, 0, 1), (3, 1, 1)], "doc_id long, quality int, toxic int")
    rows = [(1, "fine words " * 30), (1, "fine words " * 30), (None, None), (None, ""), (3, "*** ### " * 50), (4, "w" * 200_000)]
    got = importance.classify(documents(rows), labels).collect()
    assert len(got) == len(rows)
    assert {r.kept for r in got if r.doc_id == 1} == {True}
    assert importance.classify(documents([]), labels).collect() == [] and importance.keep_good(documents([]), labels).collect() == []
    assert importance.classify(documents(rows), labels.limit(0)).count() == len(rows)


# line deduplication


def brute_line_dedup(rows, min_words):
    """Spans to cut by (doc_id, text), from a table of all units in rank order."""
    first, spans = {}, {}
    for i, text in sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0)):
        start = 0
        own = []
        for line in text.split("\n"):
            pieces = [(0, len(line))]
            marks = [m for m in re.finditer(r"(?<=[.!?])\s+", line) if m.end() < len(line)]
            if marks:
                cuts = [0] + [m.end() for m in marks]
                pieces += list(zip(cuts, [m.start() for m in marks] + [len(line)]))
            for a, b in pieces:
                words = line[a:b].lower().split()
                if len(words) >= min_words:
                    own.append((start + a, " ".join(words), start + b))
            start += len(line) + 1
        for a, unit, b in sorted(own, key=lambda u: u[0]):
            if first.setdefault(unit, (i, text, a)) != (i, text, a):
                spans.setdefault((i, text), []).append((a, b))
    return {k: line_dedup.outermost(v) for k, v in spans.items()}


def test_repeats_equal_brute_force(spark, documents):
    rng = random.Random(2)
    pool = [" ".join(rng.choice("ab cd ef Gh ij kl".split()) for _ in range(rng.randint(1, 9))) + rng.choice((".", "!", "")) for _ in range(40)]
    rows = []
    for i in range(60):
        lines = [" ".join(rng.choice(pool) for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(0, 6))]
        rows.append((i, "\n".join(lines)))
    rows += [(200, ""), (201, "\n\n"), (202, rows[0][1].upper().replace(" ", "  "))]
    expected = brute_line_dedup(rows, 3)
    out = line_dedup.remove_repeats(documents(rows), min_words=3)
    assert out.columns == [*documents([]).columns, "_removed"]
    for row in out.collect():
        text = dict(rows)[row.doc_id]
        spans = expected.get((row.doc_id, text), [])
        assert [tuple(s) for s in row._removed] == spans
        assert row.text == line_dedup.cut(text, spans)


MASK = (1 << 64) - 1


def plain_mix(x):
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & MASK
    x = (x ^ x >> 27) * 0x94D049BB133111EB & MASK
    return x ^ x >> 31


def plain_words(text):
    """(begin, end, word) in lower case; a character of a script without spaces is a word."""
    unspaced = lambda c: any(a <= ord(c) <= b for a, b in line_dedup._UNSPACED)
    out, at = [], 0
    for part in re.findall(r"\s+|\S+", text):
        begin = at
        for i, c in enumerate(part):
            if c.isspace():
                continue
            if out and i and not unspaced(c) and not unspaced(part[i - 1]):
                out[-1] = (out[-1][0], at + i + 1, out[-1][2] + line_dedup.lowered(c))
            else:
                out.append((at + i, at + i + 1, line_dedup.lowered(c)))
        at = begin + len(part)
    return out


def plain_units(text, line_words):
    """(key, start, end, may overlap) of every unit; equal keys are equal texts."""
    floor, window, spread = line_dedup.MIN_WORDS, line_dedup.WINDOW, line_dedup.SPREAD
    out, lines, at = [], [], 0
    for number, line in enumerate(text.split("\n")):
        words = plain_words(line)
        if words:
            lines.append((number, at, at + len(line), words, line))
        at += len(line) + 1

    def key(begin, end):
        return "line", " ".join(line_dedup.lowered(text[begin:end]).split())

    def run(i, j):
        out.append((key(lines[i][1], lines[j][2]), lines[i][1], lines[j][2], True))

    size = [len(line[3]) for line in lines]
    for i, (number, begin, end, words, line) in enumerate(lines):
        if size[i] >= line_words:
            out.append((key(begin, end), begin, end, False))
        else:
            for j in range(i, len(lines)):
                if sum(size[i : j + 1]) >= floor:
                    run(i, j)
                    break
            for j in range(i, -1, -1):
                if sum(size[j : i + 1]) >= floor:
                    run(j, i)
                    break
            if sum(size) < floor:
                run(0, len(lines) - 1)
        if not i or lines[i - 1][0] < number - 1:
            j = i
            while j + 1 < len(lines) and lines[j + 1][0] == lines[j][0] + 1:
                j += 1
            if j > i and sum(size[i : j + 1]) >= floor:
                run(i, j)
        cuts = [0] + [k + 1 for k in range(len(words) - 1) if words[k][2][-1] in ".!?" and words[k + 1][0] > words[k][1]] + [len(words)]
        for a, b in zip(cuts, cuts[1:]):
            if len(cuts) > 2 and b - a >= floor:
                out.append((key(begin + words[a][0], begin + words[b - 1][1]), begin + words[a][0], begin + words[b - 1][1], False))
    words = plain_words(text)
    base, salt, odd = 0x9E3779B97F4A7C15, 0x2545F4914F6CDD1D, 0x9E3779B97F4A7C15
    hashes = [plain_mix(sum(plain_mix((ord(c) * odd + i) & MASK) for i, c in enumerate(w[2])) & MASK) for w in words]
    n = len(words) - window + 1
    digest = [plain_mix(sum((h ^ salt) * pow(base, k, 1 << 64) for k, h in enumerate(hashes[i : i + window])) + window & MASK) for i in range(n)]
    near = min(spread, n)
    picked = sorted({i for a in range(n - near + 1) for i in range(a, a + near) if digest[i] == min(digest[a : a + near])}) if n > 0 else []
    k = 0
    while k < len(picked):
        m = k
        while m + 1 < len(picked) and digest[picked[m + 1]] == digest[picked[k]] and picked[m + 1] - picked[m] < window:
            m += 1
        passage = tuple(w[2] for w in words[picked[k] : picked[k] + window])
        out.append((("passage", passage), words[picked[k]][0], words[picked[m] + window - 1][1], True))
        k = m + 1
    return out


def brute_all_units(rows, line_words):
    """{(doc_id, text): spans to cut} with lines, runs, paragraphs, sentences and passages."""
    found = [(key, (i is None, i, text), start, end, wide) for i, text in set(rows) for key, start, end, wide in plain_units(text or "", line_words)]
    first = {}
    for key, doc, start, _, _ in found:
        first[key] = min(first.get(key, (doc, start)), (doc, start))
    spans = {}
    for key, doc, start, end, wide in found:
        if first[key] != (doc, start):
            spans.setdefault(doc[1:], []).append((start, end, wide))
    return {k: line_dedup.all_spans(k[1], v) for k, v in spans.items()}


@pytest.mark.parametrize("line_words", [1, line_dedup.LINE_WORDS])
def test_all_units_equal_brute_force(documents, line_words):
    rng = random.Random(8)
    word = lambda: rng.choice(["alpha", "Beta", "of.", "gamma!", "δέλτα", "日本語", "x1", "zeta", "eta?", "theta"]) + rng.choice(["", "", str(rng.randrange(30))])
    line = lambda: " ".join(word() for _ in range(rng.choice([1, 2, 3, 6, 11, 25])))
    pool = [line() for _ in range(25)] + ["\n".join(line() for _ in range(4)) for _ in range(6)]
    rows = []
    for i in range(120):
        parts = [rng.choice(pool) if rng.random() < 0.5 else line() for _ in range(rng.randint(0, 7))]
        rows.append((i, "".join(p + rng.choice(["\n", "\n\n", " ", "\n \n"]) for p in parts)))
    rows += [(500, rows[3][1].upper()), (501, "of."), (502, "Of."), (503, "ab " * 300), (504, "")]
    expected = brute_all_units(rows, line_words)
    for row in line_dedup.remove_repeats(documents(rows), line_words=line_words).collect():
        spans = expected.get((row.doc_id, dict(rows)[row.doc_id]), [])
        assert [tuple(s) for s in row._removed] == spans, row.doc_id
        assert row.text == line_dedup.cut(dict(rows)[row.doc_id], spans)


def test_registered_line_query_equals_brute_force(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    expected = brute_all_units(rows, line_dedup.LINE_WORDS)
    got = {r.doc_id: ([tuple(s) for s in r.removed], r.n_removed) for r in registry.queries()["op3_line_dedup"](spark, sf).collect()}
    assert got == {i: (spans, len(spans)) for i, t in rows for spans in [expected.get((i, t), [])]}


def test_cut():
    text = "first line\nsecond line. And more. End\n\nlast"
    assert line_dedup.cut(text, []) == text
    assert line_dedup.cut(text, [(0, 10)]) == "second line. And more. End\n\nlast"
    assert line_dedup.cut(text, [(24, 33)]) == "first line\nsecond line. End\n\nlast"
    assert line_dedup.cut(text, [(0, 10), (11, 37), (39, 43)]) == ""
    assert line_dedup.cut("a b\nc d", [(4, 7)]) == "a b"


def test_long_passage_goes_wherever_it_repeats(documents):
    passage = " ".join(f"word{i}" for i in range(55))
    own = [f"document {i} begins with a line of its own and nobody else has it {i}" for i in range(50)]
    rows = [(i, f"{line}\n{passage}\n{line} end") for i, line in enumerate(own)]
    out = {r.doc_id: r.text for r in line_dedup.remove_repeats(documents(rows)).collect()}
    assert passage in out[0] and not any(passage in out[i] for i in range(1, 50))
    assert all(out[i] == f"{own[i]}\n{own[i]} end" for i in range(1, 50))


def test_line_dedup_of_odd_rows(documents):
    line = "one two three four five six seven eight nine ten eleven"
    rows = [(None, line), (None, None), (2, line), (2, line), (3, f"{line}\n{line}"), (4, ""), (5, "z " * 50_000)]
    out = line_dedup.remove_repeats(documents(rows)).collect()
    assert sorted((r.doc_id or 0, r.text if r.text is None or len(r.text) < 99 else "long") for r in out if r.doc_id) == [
        (2, line), (2, line), (3, ""), (4, ""), (5, "long")
    ]
    assert sorted((r.text for r in out if r.doc_id is None), key=str) == ["", None]
    assert line_dedup.remove_repeats(documents([])).collect() == []


def test_passages_go_inside_lines_and_without_sentence_ends(documents):
    rng = random.Random(5)
    words = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    shared = {n: words(n) for n in (line_dedup.WINDOW + line_dedup.SPREAD - 1, 60, 400)}
    rows, own = [], {}
    for n, passage in shared.items():
        for k in range(30):
            before, after = words(rng.randint(1, 20)), words(rng.randint(1, 20))
            i = len(rows)
            own[i] = (n, k, before, after)
            rows.append((i, " ".join([*before, *[w.upper() if k % 2 else w for w in passage], *after])))
    for row in line_dedup.remove_repeats(documents(rows)).collect():
        n, k, before, after = own[row.doc_id]
        left = row.text.split()
        if k == 0:
            assert row.text == rows[row.doc_id][1] and not row._removed
        else:
            assert left[: len(before)] == before and left[-len(after) :] == after
            assert len(left) - len(before) - len(after) <= min(n - line_dedup.WINDOW, 2 * (line_dedup.SPREAD - 1))
            assert row.text == line_dedup.cut(rows[row.doc_id][1], [tuple(s) for s in row._removed])


def test_wrapped_passages_go(documents):
    rng = random.Random(6)
    words = [f"w{rng.randrange(10**6)}" for _ in range(60)]
    wrap = lambda n, given=words: "\n".join(" ".join(given[i : i + n]) for i in range(0, len(given), n))
    short = wrap(4, words[:12])
    rows = [(0, f"one begin\n\n{wrap(8)}\n\none end"), (1, f"two begin\n\n{wrap(8)}\n\ntwo end"), (2, f"three begin\n\n{wrap(5)}\n \nthree end"), (3, f"four\n\n{short}\n\nfour x")]
    rows += [(4, f"five {wrap(7)} five"), (5, f"six\n\n{wrap(6, words[:12])}\n\nsix x"), (6, f"seven\n{wrap(9)}\nseven x")]
    out = {r.doc_id: r.text for r in line_dedup.remove_repeats(documents(rows)).collect()}
    assert out[0] == rows[0][1] and out[3] == rows[3][1]
    assert out[1] == "two begin\n\n\ntwo end" and out[2] == "three begin\n\n \nthree end" and out[5] == "six\n\n\nsix x"
    for i in (4, 6):
        assert len(out[i].split()) <= 3 + 2 * (line_dedup.SPREAD - 1) and out[i].split()[0] == rows[i][1].split()[0]


def test_short_lines_and_unspaced_scripts(documents):
    rng = random.Random(7)
    shared = "".join(chr(rng.randrange(0x4E00, 0x9FFF)) for _ in range(80))
    thai = "".join(chr(rng.randrange(0x0E01, 0x0E2F)) for _ in range(60))
    rows = [(0, f"Read more\nzero\n甲{shared}乙"), (1, f"one is here. Read more. x\nread  MORE\n丙丁{shared}戊"), (2, f"Read more\nzero\n{shared}"), (3, f"a{thai}b"), (4, f"cd {thai} e")]
    out = {r.doc_id: r.text for r in line_dedup.remove_repeats(documents(rows)).collect()}
    assert out[0] == rows[0][1] and out[3] == rows[3][1]
    assert out[1].startswith("one is here. Read more. x\n丙丁") and out[1].endswith("戊") and len(out[1]) < 26 + 3 + 23
    assert len(out[2]) <= 22 and "zero" not in out[2] and out[4].startswith("cd") and len(out[4]) < 4 + 24


def test_passages_of_odd_texts():
    assert list(line_dedup.passages("")) == [] and list(line_dedup.passages(" ".join("abc" * 5))) == []
    assert [p[2:] for p in line_dedup.passages("z " * 5000)] == [(0, 9999)]
    text = " ".join(str(i) for i in range(200)) + " \u0130x \U00020000\U00020001\u3000y " + "\u65e5\u672c" * 30
    start, end, hashes = line_dedup.word_hashes(text)
    assert [text[a:b] for a, b in zip(start, end)][198:206] == ["198", "199", "\u0130x", "\U00020000", "\U00020001", "y", "\u65e5", "\u672c"]
    piece, line_dedup.PIECE = line_dedup.PIECE, 9
    try:
        assert all((a == b).all() for a, b in zip(line_dedup.word_hashes(text), (start, end, hashes)))
    finally:
        line_dedup.PIECE = piece


# decontamination


def brute_contamination(rows, items, window=10):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    words = lambda t: word.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    runs = {}
    for i, text in items:
        w = words(text)
        for k in range(max(1, len(w) - window + 1) if w else 0):
            runs.setdefault(tuple(w[k : k + window]), set()).add(str(i))
    out = []
    for i, text in rows:
        w = words(text)
        hit, found = set(), set()
        for size in {len(r) for r in runs}:
            for k in range(len(w) - size + 1):
                if tuple(w[k : k + size]) in runs:
                    hit |= set(range(k, k + size))
                    found |= runs[tuple(w[k : k + size])]
        out.append((i, len(w), len(hit), len(found), bool(hit)))
    return out


@pytest.mark.parametrize("broadcast", [1 << 20, 0])
def test_contamination_equals_brute_force(spark, documents, broadcast, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST", broadcast)
    rng = random.Random(3)
    vocabulary = "the a of É日 b2 c-d It".split()
    words = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, words(rng.choice((1, 2, 3, 5, 10, 11, 14)))) for i in range(25)] + [(90, None), (91, "!!"), (92, "a of the a of the a of the a of the a"), (93, "a of the a of the a of the a of the a")]
    rows = [(i, words(rng.choice((0, 1, 4, 30, 80)))) for i in range(40)]
    rows += [(100 + i, f"{words(5)}, {items[i][1]}! {words(4)}") for i in range(25)] + [(300, None), (301, "a of the " * 40), (302, "...")]
    benchmark = spark.createDataFrame(items, "item_id long, text string").withColumn("words", F.lit(1)).withColumn("key", F.lit(None).cast("long"))
    got = decontaminate.contamination(documents(rows), benchmark)
    assert sorted((r.doc_id, r.n_words, r.n_hit, r.n_items, r.contaminated) for r in got.collect()) == sorted(brute_contamination(rows, items))
    clean = decontaminate.keep_clean(documents(rows), benchmark)
    assert clean.columns == documents([]).columns
    assert {r.doc_id for r in clean.collect()} == {i for i, _, _, _, bad in brute_contamination(rows, items) if not bad}


def test_contamination_of_odd_tables(spark, documents):
    benchmark = spark.createDataFrame([(1, "one two three four five six seven eight nine ten")], "item_id long, text string")
    rows = [(None, "x one two three four five six seven eight nine ten y"), (None, None), (5, "one"), (5, "one")]
    got = decontaminate.contamination(documents(rows), benchmark).collect()
    assert sorted((r.doc_id or 0, r.n_words, r.n_hit, r.contaminated) for r in got) == [(0, 0, 0, False), (0, 12, 10, True), (5, 1, 0, False), (5, 1, 0, False)]
    assert decontaminate.contamination(documents([]), benchmark).collect() == []
    assert decontaminate.contamination(documents(rows), benchmark.limit(0)).filter("contaminated").count() == 0
    assert decontaminate.keep_clean(documents(rows), benchmark.limit(0)).count() == 4


def test_decontamination_runs_no_python(documents, spark):
    benchmark = spark.createDataFrame([(1, "one two three four")], "item_id long, text string")
    for df in (decontaminate.contamination(documents([(1, "a")]), benchmark), decontaminate.keep_clean(documents([(1, "a")]), benchmark)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan)


# toxicity


def test_held_out_toxicity(tables):
    labels = tables["labels"]
    got = toxicity.classify(tables["documents"], labels.filter("doc_id % 4 <> 1"))
    rows = got.join(labels.filter("doc_id % 4 = 1").withColumnRenamed("toxic", "is_toxic"), "doc_id").select("toxic", "is_toxic").collect()
    assert np.mean([r.toxic == bool(r.is_toxic) for r in rows]) > 0.85


def test_chain_feeds_earlier_probabilities():
    rng = random.Random(5)
    features, targets = [], []
    for _ in range(400):
        a, b = rng.random() < 0.3, rng.random() < 0.3
        features.append(set(([10] if a else []) + ([20] if b else []) + [rng.randrange(100, 400) for _ in range(20)]))
        targets.append((a, a or b))
    rows = np.repeat(np.arange(400), [len(f) for f in features])
    columns = np.array([b for f in features for b in f])
    chain = toxicity.train_chain(rows, columns, np.array(targets, int), np.arange(400) % 5)
    assert len(chain.links[0].earlier) == 0 and len(chain.links[1].earlier) == 1
    p = np.array([chain.probabilities(f) for f in features])
    assert ((p >= 0.5) == np.array(targets)).mean() > 0.98


def test_toxicity_of_odd_rows(spark, documents):
    labels = spark.createDataFrame([(i, 1, int(i < 20)) for i in range(60)] + [(None, 1, 1), (61, 1, None)], "doc_id long, quality int, toxic int")
    rng = random.Random(7)
    rows = [(i, " ".join(rng.choice("abcdefghij") * 3 for _ in range(30)) + (" such an idiot" if i < 20 else "")) for i in range(60)]
    odd = [(None, "what an IDIOT!"), (100, None), (101, ""), (7, "calm"), (102, "word " * 100_000)]
    got = toxicity.classify(documents(rows + odd), labels).collect()
    assert len(got) == 65
    flagged = {r.doc_id for r in got if r.toxic}
    assert None in flagged and set(range(20)) - {7} <= flagged and not flagged & {100, 101, 102, *range(20, 60)}
    assert toxicity.classify(documents([]), labels).collect() == []
    assert toxicity.classify(documents(rows), labels.limit(0)).filter("toxic").count() == 0

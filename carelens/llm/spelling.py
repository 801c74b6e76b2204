"""Spelling variants: words one edit apart, found with pivotal grams, grouped under the frequent form.

Each word's bigrams are ordered by rarity among the words. Its prefix are the three rarest (all that tie with the third included); its pivots
are two disjoint ones of these with the least total frequency, chosen by dynamic programming. One edit leaves at least one of two disjoint
bigrams whole, so of two near words the one whose prefix ends at the rarer bigram has a pivot in the other's prefix. The
position limits of one edit say where: everything on one side of that bigram is equal, and the lengths differ by at most one. Pivots and
prefixes meet in a join on the gram with that side and the length; the words that meet are then verified.

No join broadcasts: Spark takes the keys of a word for one row and Parquet's bytes for those in memory, so it would send the driver
tables many times the size of its threshold.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelens.llm.common import documents, release
from carelens.session import materialise

RUN = re.compile("[A-Za-zÀ-ÿ]+")
#: Edits allowed and code points of a gram.
EDITS, GRAM = 1, 2
#: Distinct words gathered before they are handed on.
GATHERED = 1 << 17


def runs(text: str) -> list[str]:
    """Maximal runs of letters, with A-Z (only) in lower case."""
    return RUN.findall(text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass"))


def damaged(doc_id: object, run: str, every: int) -> str:
    """The run without one code point, if ``every`` divides the CRC-32 of ``<doc_id>:<run>``."""
    h = crc32(f"{doc_id}:{run}".encode())
    if h % every:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def words(df: DataFrame, every: int | None = None, min_length: int = 5, min_count: int = 3, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """word and n (occurrences in all texts) of words with at least ``min_length`` code points and ``min_count`` occurrences.

    With ``every``, some runs lose a code point first (:func:`damaged`). Null texts have no words; a null id reads as the empty string.
    """

    def run(batches):
        release()
        total: Counter[str] = Counter()

        def gathered():
            out = pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], ["word", "n"])
            total.clear()
            return out

        for batch in batches:
            for key, text in zip(batch.column(0), batch.column(1)):
                found = Counter(runs(text.as_py()))
                if every is not None:
                    key = key.as_py()
                    start = crc32(f"{'' if key is None else key}:".encode())
                    for r in [r for r in found if crc32(r.encode(), start) % every == 0]:
                        n = found.pop(r)
                        total[damaged("" if key is None else key, r, every)] += n
                total.update(found)
                if len(total) >= GATHERED:
                    yield gathered()
        yield gathered()

    each = documents(df, doc_id, text).mapInArrow(run, "word string, n long").filter(F.length("word") >= min_length)
    return each.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


def pivots(places: list[int], weights: list[int], count: int = EDITS + 1, gram: int = GRAM) -> list[int]:
    """``count`` disjoint ones of the ascending ``places`` with the least total weight (ties: the leftmost), by dynamic programming."""
    # best[j][i]: least (weight, places) of j disjoint grams among the first i places
    best: list[list[tuple | None]] = [[(0, ())] * (len(places) + 1)]
    for _ in range(count):
        row: list[tuple | None] = [None]
        for i, (place, weight) in enumerate(zip(places, weights)):
            before = i
            while before and places[before - 1] > place - gram:
                before -= 1
            last = best[-1][before]
            taken = None if last is None else (last[0] + weight, (*last[1], place))
            row.append(min((x for x in (row[-1], taken) if x is not None), default=None))
        best.append(row)
    return list(best[-1][-1][1])


def signature(word: str, rank: dict[str, int], frequency: dict[str, int]) -> tuple[int, list[int], list[int]]:
    """Rank of the prefix's last gram, the places of the prefix's grams and those of the pivots."""
    ranks = [rank[word[i : i + GRAM]] for i in range(len(word) - GRAM + 1)]
    last = sorted(ranks)[GRAM * EDITS]
    prefix = [i for i, r in enumerate(ranks) if r <= last]
    return last, prefix, pivots(prefix, [frequency[word[i : i + GRAM]] for i in prefix])


def _key(side: str, length: int, part: str) -> int:
    return xxhash.xxh64_intdigest(f"{side}{length}:{part}".encode()) - (1 << 63)


def index_keys(word: str, places: list[int]) -> Iterator[int]:
    """A key for each gram of the prefix and each side of it: the gram with all that lies on that side, and the word's length."""
    for i in places:
        yield _key("<", len(word), word[: i + GRAM])
        yield _key(">", len(word), word[i:])


def probe_keys(word: str, places: list[int]) -> Iterator[int]:
    """The keys under which a word one edit away has one of these grams in place."""
    for i in places:
        for length in (len(word) - 1, len(word), len(word) + 1):
            yield _key("<", length, word[: i + GRAM])
            yield _key(">", length, word[i:])


def gram_counts(table: DataFrame) -> dict[str, int]:
    """How often each bigram occurs in the words: at most the square of the alphabet, 90 letters for :data:`RUN`."""
    grams = F.transform(F.sequence(F.lit(1), F.length("word") - (GRAM - 1)), lambda i: F.substring("word", i, F.lit(GRAM)))
    return {r.g: r.n for r in table.select(F.explode(grams).alias("g")).groupBy("g").agg(F.count(F.lit(1)).alias("n")).collect()}


def near_pairs(table: DataFrame) -> DataFrame:
    """Pairs of words exactly one insertion, deletion or replacement apart, once each: a, a_n, b, b_n (a < b).

    ``table`` has distinct words of at least 4 code points, and their n; words are letters of :data:`RUN`, so that grams stay few.
    """
    frequency = gram_counts(table)
    rank = {g: i for i, g in enumerate(sorted(frequency, key=lambda g: (frequency[g], g)))}

    def keyed(probing: bool):
        def run(batches):
            release()
            for batch in (b.slice(i, 2048) for b in batches for i in range(0, b.num_rows, 2048)):
                keys, rows, lasts = [], [], []
                for row, word in enumerate(batch.column(0).to_pylist()):
                    last, prefix, chosen = signature(word, rank, frequency)
                    found = sorted(set(probe_keys(word, chosen) if probing else index_keys(word, prefix)))
                    keys += found
                    rows += [row] * len(found)
                    lasts += [last] * len(found)
                at = pa.array(rows, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.int64()), pa.array(lasts, pa.int32()), batch.column(0).take(at), batch.column(1).take(at)], ["key", "last", "word", "n"]
                )

        return table.select("word", "n").mapInArrow(run, "key long, last int, word string, n long")

    x, y = keyed(True).alias("x"), keyed(False).alias("y")
    near = (F.col("x.last") <= F.col("y.last")) & (F.col("x.word") != F.col("y.word")) & (F.levenshtein("x.word", "y.word", EDITS) == EDITS)
    met = x.join(y.hint("merge"), (F.col("x.key") == F.col("y.key")) & near)
    one, two = (F.struct(F.col(f"{t}.word").alias("w"), F.col(f"{t}.n").alias("n")) for t in "xy")
    pairs = met.select(F.least(one, two).alias("a"), F.greatest(one, two).alias("b"))
    return pairs.select(F.col("a.w").alias("a"), F.col("a.n").alias("a_n"), F.col("b.w").alias("b"), F.col("b.n").alias("b_n")).distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """word and root: forms followed to the last. Each round doubles the steps; a form is at least twice as frequent as
    its word, so 63 steps, 6 rounds, are the most there can be. Each round is written to the shared folder."""
    current = materialise(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        on = current.select(F.col("word").alias("via"), F.col("root").alias("on"))
        step = current.join(on.hint("merge"), F.col("root") == F.col("via"), "left")
        moved = materialise(step.select("word", F.coalesce("on", "root").alias("root"), F.col("on").isNotNull().alias("moved")), "roots")
        current = moved.drop("moved")
        if not moved.filter("moved").limit(1).count():
            return current


def group_variants(table: DataFrame) -> DataFrame:
    """word, n, n_near, form, form_n, root for each row (word, n) of ``table``, whose words are distinct.

    ``n_near`` counts the words one edit away; ``form`` is the one of these with the largest n (ties: the smallest in code-point
    order) if that is at least twice the word's, else null; ``root`` is the last form reached from the word, itself if it has
    none. Words must have at least 4 code points. An empty table gives an empty table.
    """
    table = materialise(table.select("word", "n"), "words")
    pairs = materialise(near_pairs(table), "near")
    both = pairs.select(F.col("a").alias("word_"), F.col("b").alias("other"), F.col("b_n").alias("other_n")).unionAll(pairs.select("b", "a", "a_n"))
    best = both.groupBy("word_").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("n"), F.col("other").alias("word"))).alias("best"))
    chosen = -F.col("best.n") >= 2 * F.col("n")
    known = table.join(best.hint("merge"), F.col("word") == F.col("word_"), "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(chosen, F.col("best.word")).alias("form"), F.when(chosen, -F.col("best.n")).alias("form_n"),
    )
    known = materialise(known, "variants")
    roots = _roots(known.filter("form is not null")).withColumnRenamed("word", "word_")
    return known.join(roots.hint("merge"), F.col("word") == F.col("word_"), "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root")
    )

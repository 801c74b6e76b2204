"""Substring deduplication by hashing lines, paragraphs, the sentences within lines, and passages wherever they stand.

A unit is a line, a paragraph of several lines, a sentence of a line that has several, or a passage: :data:`WINDOW` neighbouring words,
whatever line breaks lie between them. Passages begin where their hash is the least of :data:`SPREAD` neighbouring ones, a rule on the
content alone, so a text of ``WINDOW + SPREAD - 1`` words (27) gives a common unit wherever it stands; of a longer one at most
``SPREAD - 1`` words (11) stay at either end. In scripts without spaces each character is a word.

A line of fewer than ``line_words`` words does not count alone, only within a run: with as many lines behind it (and, as another unit,
before it) as make :data:`MIN_WORDS` words, or with all lines of a text that has fewer. With ``line_words`` 1 every line counts alone.

Normalised units (lower case, white space as one space; of paragraphs and sentences those of at least :data:`MIN_WORDS` words) are
grouped by digest over all documents. All digests of a text come from running sums over one hash per word. The first occurrence,
by (doc_id, place in the text), stays; every other one is cut out. Cut spans are reported with their offsets in the original text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelens.llm.common import documents, free_name, quoted, release, row_blocks, row_version, text_of
from carelens.llm.hashing import _powers, mix
from carelens.session import materialise

#: Paragraphs, runs of short lines, and sentences within a line. Shorter sentences are alike by chance.
MIN_WORDS = 10
#: Shorter lines are often alike by chance. They count within a run of neighbouring lines of MIN_WORDS words.
LINE_WORDS = 5
#: Bytes of texts cut into units at once; a longer text alone and whole.
BLOCK = 1 << 17
WINDOW, SPREAD = 16, 12
#: Code points handled in one go; a word that is longer is handled whole.
PIECE = 1 << 19
#: Scripts written without spaces: Thai, Lao, Burmese, Khmer, Japanese, Chinese.
_UNSPACED = ((0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3001, 0x30FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0xFF01, 0xFF9F), (0x20000, 0x3FFFF))
_UNSPACED_SET = "".join(f"{chr(a)}-{chr(b)}" for a, b in _UNSPACED)
_LINE_TEXT = re.compile(r"[^\s](?:[^\n]*[^\s])?")
_BREAK = re.compile(rf"[\s{_UNSPACED_SET}]")
_NONE = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int32), np.empty(0, np.int32), np.empty(0, bool), np.empty(0, np.int64))
_SPACE = np.array([chr(c).isspace() for c in range(0x3001)])


def lowered(text: str) -> str:
    """Lower case of the same length, so that offsets stay."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


class Words:
    """The words of some texts, with empty lines between the texts: start and end (code points), a 64-bit hash, whether a word ends a sentence,
    its text; and the line breaks. A character of an unspaced script is a word."""

    def __init__(self, texts: list[str]):
        text = "\n\n".join(texts)
        self.base = np.cumsum([0] + [len(t) + 2 for t in texts[:-1]])
        low, begin, out, breaks = lowered(text), 0, [], []
        while begin < len(low):
            found = _BREAK.search(low, begin + PIECE) if len(low) - begin > PIECE else None
            stop = found.start() if found else len(low)
            points = np.frombuffer(low[begin:stop].encode("utf-32-le", "surrogatepass"), np.uint32)
            breaks.append(np.flatnonzero(points == 10) + begin)
            kind = np.ones(len(points) + 2, np.int8)
            kind[0] = kind[-1] = 0
            inner = kind[1:-1]
            inner[_SPACE[np.minimum(points, 0x3000)] & (points <= 0x3000)] = 0
            if int(points.max()) >= _UNSPACED[0][0]:
                for a, b in _UNSPACED:
                    inner[(points >= a) & (points <= b)] = 2
            start = np.flatnonzero((inner != 0) & ((kind[:-2] != inner) | (inner == 2)))
            end = np.flatnonzero((inner != 0) & ((kind[2:] != inner) | (inner == 2))) + 1
            if len(start):
                final = points[end - 1]
                lead = int(start[0])
                points, inner, at = points[lead:], inner[lead:], start - lead
                place = np.arange(len(points)) - np.repeat(at, np.diff(at, append=len(points)))
                value = mix(points.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + place.astype(np.uint64))
                value[inner == 0] = 0
                out.append((start + begin, end + begin, mix(np.add.reduceat(value, at)), (final == 46) | (final == 33) | (final == 63)))
            begin = stop
        if not out:
            out = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, bool))]
        self.start, self.end, self.hash, self.final = (np.concatenate(x) for x in zip(*out))
        self.breaks = np.concatenate(breaks) if breaks else np.empty(0, np.int64)
        self.length = len(text)
        self.text = np.searchsorted(self.base, self.start, "right") - 1
        size = 1 << max(20, len(self.start).bit_length())
        power, inverse = _powers(size) if size == 1 << 20 else _powers.__wrapped__(size)
        self._power, self._inverse = power[: len(self.start)], inverse

    def _sums(self, value: np.ndarray) -> np.ndarray:
        total = np.zeros(len(value) + 1, np.uint64)
        np.cumsum(value * self._power, out=total[1:])
        return total

    def _of(self, total: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Hash of the words [first, last): whatever stands before them, the same words give the same hash."""
        return mix((total[last] - total[first]) * self._inverse[first] + (last - first).astype(np.uint64))

    def lines(self, min_words: int | None, line_words: int) -> tuple[np.ndarray, ...]:
        """Lines, runs of short lines, paragraphs and sentences: digest in two halves, start, end, and whether the span may overlap others."""
        glued = np.zeros(len(self.hash), bool)  # no white space before the word
        glued[1:] = self.start[1:] == self.end[:-1]
        value = np.where(glued, mix(self.hash ^ np.uint64(0x27D4EB2F165667C5)), self.hash) if glued.any() else self.hash
        begin, stop = np.concatenate(([0], self.breaks + 1)), np.concatenate((self.breaks, [self.length]))
        first, last = np.searchsorted(self.start, begin), np.searchsorted(self.start, stop)
        number = np.flatnonzero(last > first)
        begin, stop, first, last = begin[number], stop[number], first[number], last[number]
        count, n, text, found = last - first, len(self.hash), self.text[first], []

        def add(a, b, wide):  # from line a to line b
            found.append((first[a], last[b], begin[a], stop[b], np.full(len(a), wide)))

        alone = count >= (line_words if min_words is None else min_words)
        add(np.flatnonzero(alone), np.flatnonzero(alone), False)
        if min_words is None:
            short = np.flatnonzero(~alone)
            to = np.minimum(np.searchsorted(last, first[short] + MIN_WORDS), len(last) - 1)
            whole = (text[to] == text[short]) & (last[to] - first[short] >= MIN_WORDS)
            add(short[whole], to[whole], True)
            to = np.maximum(np.searchsorted(first, last[short] - MIN_WORDS, "right") - 1, 0)
            whole = (text[to] == text[short]) & (last[short] - first[to] >= MIN_WORDS)
            add(to[whole], short[whole], True)
            few = np.unique(text[short[np.bincount(self.text)[text[short]] < MIN_WORDS]])
            add(np.searchsorted(text, few), np.searchsorted(text, few, "right") - 1, True)
            edge = np.flatnonzero(number[1:] > number[:-1] + 1) + 1
            a, b = np.concatenate(([0], edge)), np.concatenate((edge - 1, [len(number) - 1]))
            several = (b > a) & (last[b] - first[a] >= MIN_WORDS)
            add(a[several], b[several], True)
        head = np.zeros(n + 1, bool)
        head[first] = head[n] = True
        seam = np.flatnonzero(self.final[:-1] & ~glued[1:]) + 1
        i = np.sort(np.concatenate((first, seam[~head[seam]])))
        j = np.append(i[1:], n)
        part = ~(head[i] & head[j]) & (j - i >= (MIN_WORDS if min_words is None else min_words))
        found.append((i[part], j[part], self.start[i[part]], self.end[j[part] - 1], np.full(int(part.sum()), False)))
        i, j, start, end, wide = (np.concatenate(x) for x in zip(*found))
        return self._of(self._sums(value), i, j), self._of(self._sums(mix(value ^ np.uint64(0x165667B19E3779F9))), i, j), start, end, wide

    def passages(self) -> tuple[np.ndarray, ...]:
        """The same for passages. A text that only repeats itself, passage over passage, is one passage."""
        n = len(self.hash) - WINDOW + 1
        at = np.arange(max(n, 0))
        d1 = self._of(self._sums(self.hash ^ np.uint64(0x2545F4914F6CDD1D)), at, at + WINDOW)
        picked = [np.empty(0, np.int64)]
        if n >= SPREAD:
            least = _sliding(d1, SPREAD, np.minimum)
            least[self.text[: len(least)] != self.text[WINDOW + SPREAD - 2 :]] = 0  # not within one text
            picked.append(np.flatnonzero(_sliding(np.pad(least, SPREAD - 1), SPREAD, np.maximum) == d1))
        size = np.bincount(self.text)
        for k in np.flatnonzero((size >= WINDOW) & (size < WINDOW + SPREAD - 1)):
            own = np.searchsorted(self.text, k) + np.arange(size[k] - WINDOW + 1)
            picked.append(own[d1[own] == d1[own].min()])
        at = np.sort(np.concatenate(picked))
        same = (d1[at][1:] == d1[at][:-1]) & (np.diff(at) < WINDOW) & (self.text[at[1:]] == self.text[at[:-1]])
        one = np.full(min(len(at), 1), True)
        first, last = at[np.concatenate((one, ~same))], at[np.concatenate((~same, one))] + WINDOW - 1
        d2 = self._of(self._sums(mix(self.hash ^ np.uint64(0x9FB21C651E98DF25))), first, first + WINDOW)
        return d1[first], d2, self.start[first], self.end[last], np.full(len(first), True)


def word_hashes(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end (code points) and hash of each word."""
    words = Words([text])
    return words.start, words.end, words.hash


def _sliding(x: np.ndarray, n: int, of: np.ufunc) -> np.ndarray:
    """``of`` (minimum or maximum) over each ``n`` neighbours."""
    width = 1
    while 2 * width <= n:
        x = of(x[:-width], x[width:])
        width *= 2
    return of(x[: len(x) - (n - width)], x[n - width :]) if width < n else x


def passages(text: str) -> Iterator[tuple[int, int, int, int]]:
    """Two halves of the digest, start and end of the passages of a text."""
    yield from zip(*(x.tolist() for x in Words([text]).passages()[:4]))


def units(texts: list[str], min_words: int | None = None, line_words: int = 1) -> tuple[np.ndarray, ...]:
    """Digest in two halves, start and end (code points) of each unit, whether its span may overlap others (runs of short
    lines, paragraphs, passages), and the index of its text. With ``min_words`` only the lines and sentences of at least so many words."""
    words = Words(texts)
    if not len(words.hash):
        return _NONE
    found = [words.lines(min_words, line_words)] + ([words.passages()] if min_words is None else [])
    d1, d2, start, end, wide = (np.concatenate(x) for x in zip(*found))
    text = np.searchsorted(words.base, start, "right") - 1
    begin = words.base[text]
    return d1.view(np.int64), d2.view(np.int64), (start - begin).astype(np.int32), (end - begin).astype(np.int32), wide, text


def cut(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the spans. A line of which nothing is left goes with its line break; white space left hanging at
    the seams within a line becomes one space."""
    if not spans:
        return text
    gone, out, start = sorted(spans), [], 0
    i = 0
    for line in text.split("\n"):
        end = start + len(line)
        kept, at, touched = [], start, False
        while i < len(gone) and gone[i][0] <= end:
            a, b = gone[i]
            if b > end and a >= end:
                break
            kept.append(text[at : max(a, at)])
            at, touched = max(at, b), True
            i += 1
        if not touched:
            out.append(line)
        else:
            kept.append(text[min(at, end) : end])
            rest = " ".join(p for p in map(str.strip, kept) if p)
            if rest:
                out.append(rest)
        start = end + 1
    return "\n".join(out)


def all_units(docs: DataFrame, min_words: int | None = None, line_words: int = 1, digests_only: bool = False) -> DataFrame:
    """One row per unit of (doc_id, text, version): digest as two longs, start, end, passage, doc_id, version; or the first long alone."""
    fields = [T.StructField("d1", T.LongType())]
    if not digests_only:
        fields += [T.StructField("d2", T.LongType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
                   T.StructField("passage", T.BooleanType()), docs.schema["doc_id"], docs.schema["version"]]
    schema = T.StructType(fields)

    def run(batches):
        release()
        for batch in batches:
            for i, j in row_blocks(batch.column(0), BLOCK):
                part = batch.slice(i, j - i)
                *made, text = units(part.column(0).to_pylist(), min_words, line_words)
                columns = [pa.array(c) for c in (made[:1] if digests_only else made)]
                columns += [] if digests_only else [part.column(k).take(pa.array(text)) for k in (1, 2)]
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    given = docs.select("text") if digests_only else docs.select("text", "doc_id", "version")
    return given.mapInArrow(run, schema)


def repeats(df: DataFrame, min_words: int | None = None, line_words: int = 1, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Spans to cut: doc_id, version (of the text), spans (array of start, end, passage in order).

    Half digests are counted first, combined before the shuffle, and only units whose half repeats are written; making
    all units again is cheaper than keeping them. First occurrences are combined before the shuffle as well, so a line that a third
    of all documents share is one row per task there. Marking occurrences is a join of two written tables, one of them with a row per
    repeated digest, so Spark splits its large partitions.
    """
    docs = documents(df, doc_id, text).withColumn("version", row_version(F.col("text")))
    halves = all_units(docs, min_words, line_words, digests_only=True).groupBy("d1").agg(F.count(F.lit(1)).alias("n"))
    halves = materialise(halves.filter("n > 1").select("d1"), "halves")
    found = materialise(all_units(docs, min_words, line_words).join(halves, "d1", "left_semi"), "units")
    rank = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id"), F.col("version"), F.col("start"))
    first = found.groupBy("d1", "d2").agg(F.min(rank).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    later = found.join(materialise(first, "first"), ["d1", "d2"]).filter(~rank.eqNullSafe(F.col("first")))
    return later.groupBy("doc_id", "version").agg(F.sort_array(F.collect_list(F.struct("start", "end", "passage"))).alias("spans"))


def remove_repeats(df: DataFrame, min_words: int | None = None, line_words: int = 1, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """All rows and columns of ``df`` with repeats cut out of the text, plus ``removed``: the cut spans.

    ``removed`` (named ``_removed`` if the column exists) holds non-overlapping (start, end) offsets in code points of
    the original text, empty if nothing was cut. Null texts stay null, and texts without a repeat stay as they are, byte for byte;
    a text that consists of repeats becomes empty, its row stays. Rows equal in id and text are one document and treated
    alike. Null ids rank last. An empty table gives an empty table. With ``min_words`` only lines and sentences of at least
    so many words are compared, no runs, paragraphs or passages. Lines of fewer than ``line_words`` words do not count alone.
    """
    spans = repeats(df, min_words, line_words, doc_id, text)
    id_, version, removed = free_name(df, "unit_id"), free_name(df, "unit_version"), free_name(df, "removed")
    keyed = df.withColumn(version, row_version(text_of(text)))
    right = spans.select(F.col("doc_id").alias(id_), F.col("version").alias(f"{version}_"), F.col("spans").alias(removed))
    # the side with spans is the smaller one of each partition: no sort of whole texts
    joined = keyed.join(
        right.hint("shuffle_hash"),
        quoted(doc_id).eqNullSafe(quoted(id_)) & (quoted(version) == quoted(f"{version}_")),
        "left",
    ).select(*map(quoted, df.columns), quoted(removed))
    position = df.columns.index(text)
    names = joined.columns
    numbered = joined.toDF(*(f"c{i}" for i in range(len(names))))  # whatever their names, such as with dots
    plain = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
    inner = numbered.columns
    schema = T.StructType([*numbered.schema.fields[:-1], T.StructField(inner[-1], plain)])

    def run(batches):
        release()
        for batch in (b.slice(i, 512) for b in batches for i in range(0, b.num_rows, 512)):
            texts = batch.column(position).to_pylist()
            given = batch.column(batch.num_columns - 1).to_pylist()
            made = [all_spans(t, [tuple(s.values()) for s in spans or []]) for t, spans in zip(texts, given)]
            new = [t if t is None else cut(t, s) for t, s in zip(texts, made)]
            columns = list(batch.columns)
            columns[position] = pa.array(new, batch.schema.field(position).type)
            columns[-1] = pa.array([[{"start": a, "end": b} for a, b in s] for s in made], pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))
            yield pa.RecordBatch.from_arrays(columns, inner)

    return numbered.mapInArrow(run, schema).toDF(*names)


def outermost(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted spans without those inside another one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans, key=lambda s: (s[0], -s[1])):
        if not out or b > out[-1][1]:
            out.append((a, b))
    return out


def all_spans(text: str | None, spans: list[tuple[int, int, bool]]) -> list[tuple[int, int]]:
    """Spans to cut, in order and apart: whole lines and sentences as they are, and of paragraphs and passages what lies
    outside these, line by line."""
    whole = outermost([(a, b) for a, b, passage in spans if not passage])
    wide: list[list[int]] = []
    for a, b in sorted((a, b) for a, b, passage in spans if passage):
        if wide and a <= wide[-1][1]:
            wide[-1][1] = max(wide[-1][1], b)
        else:
            wide.append([a, b])
    out, i = list(whole), 0
    for a, b in wide:
        while i < len(whole) and whole[i][1] <= a:
            i += 1
        k, pieces = i, []
        while k < len(whole) and whole[k][0] < b:
            pieces.append((a, whole[k][0]))
            a = whole[k][1]
            k += 1
        pieces.append((a, b))
        for c, d in pieces:
            out += [(c + m.start(), c + m.end()) for m in _LINE_TEXT.finditer(text[c:d])] if c < d else []
    return sorted(out)

"""Suffix-array deduplication: repeated byte strings of a fixed length, found with longest-previous-factor arrays.

Equal strings of ``limit`` bytes must meet before they can be compared, wherever they stand. Every start of such a string belongs to an
anchor: the :data:`GRAM` bytes within the string that have the least hash, a rule on the string's own bytes. Neighbouring starts with
the same anchor are one segment. Anchors that occur once are dropped; segments whose bytes are equal are counted as one class;
only classes that share an anchor with another class are compared by suffixes. Their starts are sorted as suffixes, and
the previous and next smaller (larger) positions in that order give each start's longest earlier (later) match.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelens.llm.common import free_name, quoted, release, row_version, text_of
from carelens.llm.hashing import _powers, mix
from carelens.session import materialise

LIMIT = 200
GRAM = 96
#: Starts of one text handled in one go, and bytes of several texts.
PIECE = 1 << 19
_PLACE = np.uint64((1 << 20) - 1)
#: Classes of one anchor compared by suffixes in one task; anchors with more are compared by a shuffle on whole strings.
MANY = 1024
#: Bytes of segments sorted at once.
BLOCK = 1 << 19


def _sliding_min(x: np.ndarray, n: int) -> np.ndarray:
    width = 1
    while 2 * width <= n:
        x = np.minimum(x[:-width], x[width:])
        width *= 2
    return np.minimum(x[: len(x) - (n - width)], x[n - width :]) if width < n else x


_SPREAD = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9FB21C651E98DF25))


def _segments(data: np.ndarray, base: np.ndarray, count: np.ndarray, limit: int, gram: int) -> tuple[np.ndarray, ...]:
    """Piece, first start (from the piece's base), number of starts, anchor hash and content hash of each segment."""
    power, inverse = _powers(1 << 20)
    n = len(data)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_SPREAD[data] * power[:n], out=total[1:])
    grams = mix((total[gram:] - total[:-gram]) * inverse[: n - gram + 1])
    place = np.arange(len(grams), dtype=np.uint64)
    anchor = (_sliding_min((grams & ~_PLACE) | place, limit - gram + 1) & _PLACE).astype(np.int64)
    start = np.arange(int(count.sum())) + np.repeat(base - (np.cumsum(count) - count), count)
    own = anchor[start]
    edge = np.flatnonzero((own[1:] != own[:-1]) | (start[1:] != start[:-1] + 1)) + 1
    first, last = start[np.concatenate(([0], edge))], start[np.concatenate((edge - 1, [len(start) - 1]))]
    content = mix(((total[last + limit] - total[first]) * inverse[first]) ^ (last - first).astype(np.uint64))
    piece = np.searchsorted(base, first, "right") - 1
    return piece, first - base[piece], last - first + 1, grams[anchor[first]].view(np.int64), content.view(np.int64)


def segments(texts: list[bytes], limit: int = LIMIT, gram: int = GRAM) -> Iterator[tuple[np.ndarray, ...]]:
    """Row, first start, number of starts, anchor hash and content hash, some blocks of texts at a time."""

    def pieces():
        for row, text in enumerate(texts):
            starts = len(text) - limit + 1
            for at in range(0, starts, PIECE):
                n = min(PIECE, starts - at)
                yield row, at, n, text[at : at + n + limit - 1] if starts > PIECE else text

    def block(found):
        rows, offsets, counts, data = zip(*found)
        size = np.fromiter(map(len, data), np.int64, len(data))
        out = _segments(np.frombuffer(b"".join(data), np.uint8), np.cumsum(size) - size, np.array(counts), limit, gram)
        piece = out[0]
        return np.array(rows)[piece], out[1] + np.array(offsets)[piece], *out[2:]

    held, size = [], 0
    for piece in pieces():
        if held and size + len(piece[3]) > PIECE:
            yield block(held)
            held, size = [], 0
        held.append(piece)
        size += len(piece[3])
    if held:
        yield block(held)


def _to_previous_smaller(value: np.ndarray, lcp: np.ndarray) -> np.ndarray:
    """For each place the common prefix with the nearest earlier place whose value is smaller (0: none).

    All places step at once: a place whose candidate is larger takes the candidate's own candidate, and the least common prefix on the way.
    """
    value = np.concatenate(([-1], value))
    at, common = np.arange(-1, len(value) - 1), np.concatenate(([0], lcp))
    at[0] = 0
    wrong = np.flatnonzero(value[at] > value)
    while len(wrong):
        via = at[wrong]
        common[wrong] = np.minimum(common[wrong], common[via])
        at[wrong] = at[via]
        wrong = wrong[value[at[wrong]] > value[wrong]]
    common[at == 0] = 0
    return common[1:]


def factors(data: np.ndarray, starts: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Longest previous and next factor of each of the ascending ``starts``: the length, up to ``limit``, of the longest string there
    that also begins at an earlier (a later) one of them. Each start must have ``limit`` bytes."""
    suffix = np.ndarray((len(data) - limit + 1,), f"S{limit}", buffer=data, strides=(1,))[starts]
    order = np.argsort(suffix, kind="stable")  # the suffix array; equal strings by position
    rows = suffix[order].view(np.uint8).reshape(len(starts), limit)
    differs = rows[1:] != rows[:-1]
    lcp = np.zeros(len(starts), np.int64)
    lcp[1:] = np.where(differs.any(axis=1), differs.argmax(axis=1), limit)
    back = np.concatenate(([0], lcp[:0:-1]))
    out = []
    for value in (order, len(order) - 1 - order):  # smaller positions are earlier, larger ones later
        best = np.maximum(_to_previous_smaller(value, lcp), _to_previous_smaller(value[::-1], back)[::-1])
        factor = np.empty_like(best)
        factor[order] = best
        out.append(factor)
    return out[0], out[1]


def runs(flags: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last index of each run of true flags within one group."""
    at = np.flatnonzero(flags)
    if not len(at):
        return at, at
    edge = np.flatnonzero((at[1:] != at[:-1] + 1) | (group[at[1:]] != group[at[:-1]])) + 1
    return at[np.concatenate(([0], edge))], at[np.concatenate((edge - 1, [len(at) - 1]))]


def _marked(keys: list[tuple[int, int]], texts: list[bytes], limit: int, later: bool) -> tuple[np.ndarray, ...]:
    """Key index, begin and end of the runs of starts that repeat in another text (with ``later`` false only in an earlier one)."""
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    base, count = np.cumsum(size) - size, size - limit + 1
    group = np.repeat(np.arange(len(texts)), count)
    offset = np.arange(len(group)) - np.repeat(np.cumsum(count) - count, count)
    before, after = factors(np.frombuffer(b"".join(texts), np.uint8), base[group] + offset, limit)
    a, b = runs((before >= limit) | (later & (after >= limit)), group)
    return group[a], offset[a], offset[b] + 1


_KEYS = T.StructType([T.StructField("h", T.LongType()), T.StructField("s", T.LongType())])
_RANGE = T.StructType([*_KEYS.fields, T.StructField("from", T.IntegerType()), T.StructField("to", T.IntegerType())])


def _keyed(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    return df.select(quoted(doc_id).alias("doc_id"), row_version(text_of(text)).alias("version"), text_of(text).cast("binary").alias("text"))


def _all_segments(docs: DataFrame, limit: int, gram: int) -> DataFrame:
    """One row per segment: doc_id, version, start, size (number of starts), h (anchor), s (content)."""
    schema = T.StructType(
        [docs.schema["doc_id"], docs.schema["version"], T.StructField("start", T.IntegerType()), T.StructField("size", T.IntegerType()), *_KEYS.fields]
    )

    def run(batches):
        release()
        for batch in batches:
            for row, start, size, h, s in segments(batch.column(2).to_pylist(), limit, gram):
                rows = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(rows), batch.column(1).take(rows), pa.array(start.astype(np.int32)), pa.array(size.astype(np.int32)), pa.array(h), pa.array(s)],
                    schema.names,
                )

    return docs.mapInArrow(run, schema)


def _rank() -> F.Column:
    return F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "version", "start")


def _contested_text(docs: DataFrame, contested: DataFrame, limit: int) -> DataFrame:
    """The bytes of the first segment of each contested class: h, s, classes, rank columns, bytes."""
    wanted = contested.select("first.doc_id", "first.version", F.struct("first.start", "size", "h", "s", "classes").alias("one"))
    lists = wanted.groupBy("doc_id", "version").agg(F.collect_list("one").alias("wanted"))  # bounded by the text's own length
    right = lists.toDF("id_", "version_", "wanted").hint("shuffle_hash")
    pairs = docs.join(right, F.col("doc_id").eqNullSafe(F.col("id_")) & (F.col("version") == F.col("version_"))).select("doc_id", "version", "text", "wanted")
    schema = T.StructType(
        [*_KEYS.fields, T.StructField("classes", T.LongType()), docs.schema["doc_id"], docs.schema["version"], T.StructField("start", T.IntegerType()), T.StructField("bytes", T.BinaryType())]
    )

    def run(batches):
        release()
        for batch in batches:
            for i in range(batch.num_rows):
                text = batch.column(2)[i].as_py()
                listed = batch.column(3).slice(i, 1).flatten()
                start, size, h, s, classes = (listed.field(k) for k in range(5))
                cuts = [text[a : a + n + limit - 1] for a, n in zip(start.to_pylist(), size.to_pylist())]
                rows = pa.array([i] * len(cuts), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [h, s, classes, batch.column(0).take(rows), batch.column(1).take(rows), start, pa.array(cuts, pa.binary())], schema.names
                )

    return pairs.mapInArrow(run, schema)


def _by_suffixes(slices: DataFrame, limit: int, later: bool) -> DataFrame:
    """Runs of repeated starts of the classes of each anchor, all classes of an anchor in one block."""

    def run(batches):
        release()
        keys, texts, size = [], [], 0

        def made():
            group, a, b = _marked(keys, texts, limit, later)
            h, s = (np.array([k[i] for k in keys], np.int64)[group] for i in (0, 1))
            return pa.RecordBatch.from_arrays([pa.array(h), pa.array(s), pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32))], _RANGE.names)

        for batch in batches:
            for h, s, text in zip(*(batch.column(k).to_pylist() for k in range(3))):
                if keys and keys[-1] == (h, s):
                    continue  # the same row of a repeated document
                if size >= BLOCK and keys[-1][0] != h:
                    yield made()
                    keys, texts, size = [], [], 0
                keys.append((h, s))
                texts.append(text)
                size += len(text)
        if keys:
            yield made()

    order = ["h", F.col("doc_id").isNull(), "doc_id", "version", "start", "s"]
    return slices.repartition("h").sortWithinPartitions(*order).select("h", "s", "bytes").mapInArrow(run, _RANGE)


def _by_strings(slices: DataFrame, limit: int, later: bool) -> DataFrame:
    """The same for anchors with very many classes: one row per start, counted by a digest of its string, combined before the shuffle."""
    place = F.explode(F.sequence(F.lit(1), F.length("bytes") - (limit - 1)))
    starts = slices.select("h", "s", _rank().alias("first"), "bytes", place.alias("at")).select(
        "h", "s", (F.col("at") - 1).alias("at"), "first", F.sha2(F.substring("bytes", F.col("at"), F.lit(limit)), 256).alias("string")
    )
    counted = materialise(starts.groupBy("string").agg(F.min(F.struct("first", "at")).alias("least"), F.countDistinct("h", "s").alias("n")).filter("n > 1"), "strings")
    repeated = starts.join(counted, "string")
    if not later:
        repeated = repeated.filter(~F.struct("first", "at").eqNullSafe(F.col("least")))
    return repeated.select("h", "s", F.col("at").alias("from"), (F.col("at") + 1).cast("int").alias("to")).distinct()


def repeats(df: DataFrame, limit: int = LIMIT, keep: str = "none", gram: int | None = None, many: int = MANY, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, version (of the text), spans (array of begin, end in bytes) covered by repeated strings of ``limit`` bytes."""
    gram = gram or min(GRAM, max(1, limit // 2))
    docs, later = _keyed(df, doc_id, text), keep == "none"
    every = _all_segments(docs, limit, gram)
    anchors = materialise(every.groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("h"), "anchors")
    found = materialise(every.join(anchors, "h", "left_semi"), "segments")
    classes = materialise(found.groupBy("h", "s").agg(F.count(F.lit(1)).alias("n"), F.min(_rank()).alias("first"), F.min("size").alias("size")), "classes")
    per_anchor = classes.groupBy("h").agg(F.count(F.lit(1)).alias("classes"), F.min("n").alias("least")).filter("classes > 1")
    if later:
        per_anchor = per_anchor.filter("least = 1")  # otherwise every class repeats as a whole
    contested = classes.join(per_anchor, "h")
    slices = materialise(_contested_text(docs, contested, limit), "slices")
    marks = _by_suffixes(slices.filter(F.col("classes") <= many), limit, later)
    if per_anchor.filter(F.col("classes") > many).limit(1).count():
        marks = marks.unionByName(_by_strings(slices.filter(F.col("classes") > many), limit, later))
    whole = classes.filter("n > 1").select("h", "s", F.lit(0).alias("from"), F.col("size").alias("to"), F.lit(True).alias("whole"), "first")
    part = marks.join(classes.select("h", "s", "n", "first"), ["h", "s"])
    if later:
        part = part.filter("n = 1")
    status = materialise(whole.unionByName(part.select("h", "s", "from", "to", F.lit(False).alias("whole"), "first")), "status")
    spans = found.join(status.drop("first") if later else status, ["h", "s"])
    if not later:
        spans = spans.filter(F.col("whole") != _rank().eqNullSafe(F.col("first")))
    span = F.struct((F.col("start") + F.col("from")).alias("begin"), (F.col("start") + F.col("to") + (limit - 1)).alias("end"))
    return spans.groupBy("doc_id", "version").agg(F.collect_list(span).alias("spans"))


def union_of(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs covered by the spans, in order; touching spans are one run."""
    order = np.argsort(begin, kind="stable")
    begin, end = begin[order], np.maximum.accumulate(end[order])
    new = np.flatnonzero(begin[1:] > end[:-1]) + 1
    return begin[np.concatenate(([0], new))], end[np.concatenate((new - 1, [len(end) - 1]))]


def remove_repeats(df: DataFrame, limit: int = LIMIT, keep: str = "none", gram: int | None = None, many: int = MANY, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """All rows and columns of ``df`` plus ``kept`` (binary) and ``removed`` (spans).

    A byte is removed if a string of ``limit`` bytes that covers it also begins at another place of any row, the same row included; with
    ``keep="first"`` only if it also begins at an earlier place, so that the first copy stays (order: doc_id, nulls last, then
    place in the text). Strings are judged on the input. ``kept`` is the rest of the UTF-8 bytes, which may end within a
    character; ``removed`` holds (begin, end) of the maximal runs in bytes of the input. Null texts count as empty; texts shorter than
    ``limit`` stay whole. Rows equal in id and text are copies of each other with ``keep="none"`` and one document with ``keep="first"``:
    they are treated alike. Both names get underscores in front where ``df`` has them. An empty table gives an empty table.
    """
    spans = repeats(df, limit, keep, gram, many, doc_id, text)
    version, data, kept = free_name(df, "unit_version"), free_name(df, "unit_bytes"), free_name(df, "kept")
    keyed = df.withColumn(version, row_version(text_of(text))).withColumn(data, text_of(text).cast("binary"))
    id_, removed = free_name(keyed, "unit_id"), free_name(df, "removed")
    right = spans.select(F.col("doc_id").alias(id_), F.col("version").alias(f"{version}_"), F.col("spans").alias(removed))
    joined = keyed.join(
        right.hint("shuffle_hash"), quoted(doc_id).eqNullSafe(quoted(id_)) & (quoted(version) == quoted(f"{version}_")), "left"
    ).select(*map(quoted, df.columns), quoted(data), quoted(removed))
    numbered = joined.toDF(*(f"c{i}" for i in range(len(joined.columns))))  # whatever their names, such as with dots
    names = numbered.columns
    pair = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))

    def run(batches):
        release()
        for batch in batches:
            texts, rest, spans, ends = batch.column(len(names) - 2), [], [], [0]
            listed = batch.column(len(names) - 1)
            for i in range(batch.num_rows):
                text = texts[i].as_py()
                if listed[i].is_valid:
                    flat = listed.slice(i, 1).flatten()
                    a, b = union_of(flat.field(0).to_numpy(zero_copy_only=False), flat.field(1).to_numpy(zero_copy_only=False))
                    view = memoryview(text)
                    text = b"".join(view[x:y] for x, y in zip([0, *b.tolist()], [*a.tolist(), len(text)]))
                    spans += zip(a.tolist(), b.tolist())
                rest.append(text)
                ends.append(len(spans))
            flat = pa.StructArray.from_arrays([pa.array([s[k] for s in spans], pa.int32()) for k in (0, 1)], ["begin", "end"])
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat).cast(pair)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], pa.array(rest, pa.binary()), lists], names)

    return numbered.mapInArrow(run, numbered.schema).toDF(*df.columns, kept, removed)

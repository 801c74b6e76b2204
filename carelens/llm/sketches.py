"""Bottom-k sketches of word shingles.

A sketch is the ``k`` smallest of the distinct 64-bit hashes of a text's shingles of ``n`` words. The union of two
sketches, cut to its k smallest, is the sketch of both texts' shingles together, so sketches of parts merge. The share of
these k that both sketches hold estimates the resemblance; the k-th value estimates the number of distinct shingles.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelens.llm.common import blocks, documents, row_version
from carelens.llm.hashing import BY_SPACE, chained, joined, words

K, SHINGLE = 128, 5


def sketch_many(texts: list[bytes], k: int = K, n: int = SHINGLE) -> list[np.ndarray]:
    """Sorted sketch of each text. Fewer than ``n`` words are one shingle; no words: an empty sketch."""
    out: list[np.ndarray] = []
    for a, b in blocks(texts, 1 << 19):
        data, begins = joined(texts[a:b])
        at, hashes = words(data, BY_SPACE)
        edges = np.searchsorted(at, np.append(begins, len(data) + 1))
        runs = chained(hashes, n) if len(hashes) >= n else hashes[:0]
        for i in range(b - a):
            first, last = edges[i], edges[i + 1]
            if last - first >= n:
                own = runs[first : last - n + 1]
            elif last > first:
                own = chained(hashes[first:last], last - first)
            else:
                own = hashes[:0]
            out.append(smallest(own, k))
    return out


def smallest(values: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` smallest distinct values, sorted."""
    if len(values) > 4 * k:  # most are far above the k-th
        part = np.unique(values[values <= np.partition(values, 2 * k)[2 * k]])
        if len(part) >= k:
            return part[:k]
    return np.unique(values)[:k]


def merge(a: np.ndarray, b: np.ndarray, k: int = K) -> np.ndarray:
    """The sketch of both texts' shingles together."""
    return np.union1d(a, b)[:k]


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated Jaccard similarity; two empty sketches are alike."""
    union = merge(a, b, k)
    if not len(union):
        return 1.0
    common = np.intersect1d(a, b, assume_unique=True)
    return float(np.count_nonzero(common <= union[-1]) / len(union))


def distinct_shingles(sketch: np.ndarray, k: int = K) -> float:
    """Estimated number of distinct shingles; exact below ``k``."""
    return float(len(sketch)) if len(sketch) < k else (k - 1) / ((float(sketch[-1]) + 1) / 2.0**64)


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of the first text's shingles that the second has; an empty text is contained."""
    if not len(a):
        return 1.0
    both = resemblance(a, b, k) * distinct_shingles(merge(a, b, k), k)
    return min(1.0, both / distinct_shingles(a, k))


def to_text(sketch: np.ndarray) -> str:
    """Base64 of the big-endian values; the empty sketch is the empty string."""
    return base64.b64encode(sketch.astype(">u8").tobytes()).decode()


def from_text(text: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(text), ">u8").astype(np.uint64)


def sketches(df: DataFrame, k: int = K, n: int = SHINGLE, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``fingerprint`` and ``n_shingles`` (estimated, distinct) of every row; null texts are empty."""
    from carelens.llm.common import map_texts

    def run(texts):
        made = sketch_many([t.encode("utf-8", "replace") for t in texts], k, n)
        return {"fingerprint": list(map(to_text, made)), "n_shingles": [distinct_shingles(s, k) for s in made]}

    return map_texts(documents(df, doc_id, text), run, "fingerprint string, n_shingles double", ("doc_id",))


def in_order(df: DataFrame, partitions: int) -> DataFrame:
    """Rows of (doc_id, text) dealt to partitions by descending doc_id (nulls last, equal ids by text), with what follows.

    Adds ``guest``: after its own rows a partition holds, as a guest, the first row of the partition that follows (after
    the last one: of the first), so every row's successor is beside it. Only the cuts between partitions and the first id of each
    partition reach the driver: as many values as there are partitions. An id that fills several partitions is cut further by
    the hash of its texts.
    """
    low = -(1 << 63)
    keyed = df.select("doc_id", "text", F.coalesce(F.col("doc_id").cast("long"), F.lit(low)).alias("at"), row_version(F.col("text")).alias("version"))
    shares = [i / partitions for i in range(1, partitions)]
    cuts = sorted((keyed.agg(F.percentile_approx("at", shares, 10_000)).first()[0] or []) if shares else [])
    edges = F.array(*map(F.lit, cuts)) if cuts else F.lit([]).cast("array<long>")
    bounds = keyed.select("*", edges.alias("cuts"))
    below = F.size(F.filter("cuts", lambda c: c < F.col("at")))
    equal = F.size(F.filter("cuts", lambda c: c == F.col("at")))
    share = (F.shiftright("version", 32) + (1 << 31)) / float(1 << 32)
    part = (below + F.floor(share * (equal + 1)).cast("int")).alias("part")
    dealt = bounds.select("doc_id", "text", "at", "version", part)

    order = F.struct("at", "version")
    heads = {r["part"]: r["head"] for r in dealt.groupBy("part").agg(F.max(order).alias("head")).collect()}
    present = sorted(heads)
    guests = [(heads[p]["at"], heads[p]["version"], present[(i + 1) % len(present)]) for i, p in enumerate(present)]
    schema = "at long, version long, host int"
    # one row per partition
    hosts = F.broadcast(df.sparkSession.createDataFrame(guests, schema).groupBy("at", "version").agg(F.collect_set("host").alias("hosts")))
    placed = dealt.join(hosts, ["at", "version"], "left").select(
        "doc_id", "text", "at", "version",
        F.explode(
            F.concat(
                F.array(F.struct(F.col("part").alias("part"), F.lit(False).alias("guest"))),
                F.coalesce(
                    F.transform("hosts", lambda h: F.struct(h.alias("part"), F.lit(True).alias("guest"))),
                    F.lit([]).cast("array<struct<part:int,guest:boolean>>"),
                ),
            )
        ).alias("place"),
    ).select("doc_id", "text", "at", "version", "place.part", "place.guest")
    # a stable order of equal ids: by hash, then by the text itself
    return placed.repartitionById(max(1, partitions), F.col("part")).sortWithinPartitions(
        F.col("part"), F.col("guest"), F.col("at").desc(), F.col("version").desc(), F.col("text").desc()
    )


NEIGHBOUR_SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
)


def edited_copies(df: DataFrame, k: int = K, n: int = SHINGLE, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every text's sketch beside those of its edited copy and of the next text, in descending order of doc_id.

    The edited copy: the last floor(n_chars / 3) code points make way for the first as many (or all) of the next
    document; after the last comes the first. Nulls: an empty text; a null id comes last. Equal ids follow each other in an
    order fixed by their texts, and equal rows are each other's next. Texts without words have the empty fingerprint; two empty ones have
    likeness 1, an empty and another 0. An empty table gives no rows.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = in_order(documents(df, doc_id, text), partitions)

    def results(rows: list[tuple], following: list[str]) -> pa.RecordBatch:
        own = [t for _, t in rows]
        edited = [t[: len(t) - len(t) // 3] + f[: len(t) // 3] for t, f in zip(own, following)]
        code = lambda texts: [t.encode("utf-8", "replace") for t in texts]
        edited_bytes = code(edited)
        # the next row's text is the row after, but for the last
        made = sketch_many(code([*own, following[-1]]), k, n)
        other = sketch_many(edited_bytes, k, n)
        return pa.RecordBatch.from_pydict(
            {
                "doc_id": pa.array([i for i, _ in rows], pa.int64()),
                "n_chars": pa.array([len(t) for t in own], pa.int64()),
                "edited_sha256": [sha256(b).hexdigest() for b in edited_bytes],
                "fingerprint": [to_text(s) for s in made[:-1]],
                "edited_fingerprint": [to_text(s) for s in other],
                "near_edited": [resemblance(a, b, k) for a, b in zip(made, other)],
                "near_next": [resemblance(a, b, k) for a, b in zip(made, made[1:])],
            }
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []  # waiting for their next
        size, part = 0, None
        for batch in batches:
            for i, t, p, guest in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "part", "guest"))):
                if guest:
                    if rows and part == p:
                        yield results(rows, [*(x for _, x in rows[1:]), t])
                        rows, size = [], 0
                    continue
                if rows and size + len(t) > 1 << 20:
                    yield results(rows, [*(x for _, x in rows[1:]), t])
                    rows, size = [], 0
                rows.append((i, t))
                size, part = size + len(t), p

    return ordered.select("doc_id", "text", "part", "guest").mapInArrow(run, T._parse_datatype_string(NEIGHBOUR_SCHEMA))



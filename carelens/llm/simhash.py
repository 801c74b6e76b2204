"""SimHash near-duplicates, joined by the general pigeonhole principle.

If the bits are cut into m groups with thresholds t_i that add up to d - m + 1, two fingerprints that differ in at most d
bits differ in at most t_i bits of some group i (a threshold of -1 leaves its group out). Bits that vary together are put
into one group, so that the other groups part the fingerprints well. The thresholds come from a dynamic program over the
groups, on candidate counts estimated from all fingerprints. Fingerprints are then probed with every value within t_i of
their own in group i, joined on equal (group, value), and verified on all bits.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache
from itertools import accumulate, combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelens.llm.common import documents, free_name, map_texts, quoted, row_version, text_of
from carelens.llm.components import components
from carelens.session import materialise

BITS, SEED = 64, 42
SHINGLE, DISTANCE = 3, 3
#: Width of the bit groups whose value counts are collected: at most 2^16 values each.
CHUNK = 16
#: Fingerprints per (group, value) beyond which the remaining bits are partitioned too.
SPLIT_ABOVE = 4096
#: Cost of verifying a candidate pair relative to writing a probe.
PAIR_COST, PROBE_COST = 1.0, 4.0

_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """64 bits: each is set if it is set in more than half of the shingles' XXH64 values.

    A-Z are lower-cased, words lie between space, tab, line feed, vertical tab, form feed and carriage return; shingles are
    space-joined and counted as often as they occur. Fewer words make one shingle; no words give 0.
    """
    words = text.encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    data = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        hashes = [digest(data, SEED)]
    else:
        starts = list(accumulate((len(w) + 1 for w in words), initial=0))
        hashes = [digest(data[a : b - 1], SEED) for a, b in zip(starts, starts[shingle:])]
    values = np.array(hashes, np.uint64).astype(">u8").view(np.uint8).reshape(-1, 8)
    if len(hashes) < 64:
        counts = np.unpackbits(values, axis=1).sum(axis=0)
    else:
        counts = np.concatenate([np.bincount(values[:, i], minlength=256) @ _BYTE_BITS for i in range(8)])
    return int.from_bytes(np.packbits(counts * 2 > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` and ``fp`` (the 64 bits as a signed long) of each row of ``docs`` (with ``text``)."""

    def run(texts):
        return {"fp": [v - (1 << 64) if v >> 63 else v for v in (fingerprint(t, shingle) for t in texts)]}

    return map_texts(docs, run, "fp long", keep)


def bit_groups(distinct: DataFrame) -> list[list[int]]:
    """Groups of :data:`CHUNK` bits; bits that are correlated over all fingerprints stand together.

    Each task adds up 64 x 64 counts; their sum is all that is collected.
    """

    def count(batches):
        total = np.zeros((BITS, BITS), np.int64)
        for batch in batches:
            values = np.asarray(batch.column(0)).astype(np.int64).view(np.uint64)
            for part in np.array_split(values, max(1, len(values) >> 14)):
                bits = ((part[:, None] >> np.arange(BITS, dtype=np.uint64)) & np.uint64(1)).astype(np.float32)
                total += (bits.T @ bits).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(BITS * BITS)), pa.array(total.ravel())], ["cell", "n"])

    cells = distinct.select("fp").mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    both = np.zeros(BITS * BITS)
    for row in cells.collect():
        both[row["cell"]] = row["n"]
    both = both.reshape(BITS, BITS)
    n = max(1, distinct.count())
    one = np.diag(both) / n
    spread = np.sqrt(np.maximum(one * (1 - one), 1e-12))
    related = np.abs((both / n - np.outer(one, one)) / np.outer(spread, spread))
    np.fill_diagonal(related, 0)
    left, groups = list(range(BITS)), []
    while left:
        group = [max(left, key=lambda b: (related[b, left].sum(), -b))]
        left.remove(group[0])
        while left and len(group) < CHUNK:
            group.append(max(left, key=lambda b: (related[b, group].sum(), -b)))
            left.remove(group[-1])
        groups.append(sorted(group))
    return groups


def distance_counts(distinct: DataFrame, groups: list[list[int]]) -> list[np.ndarray]:
    """For each group, the number of ordered pairs of fingerprints at each distance within the group's bits; exact.

    The value counts of a group (at most 2^16) are collected; their XOR-correlation, by a Walsh-Hadamard transform, counts the
    pairs for every difference.
    """

    def packed(bits):
        value = F.lit(0)
        for place, bit in enumerate(bits):
            value = value + F.shiftleft(F.shiftright("fp", bit).bitwiseAND(F.lit(1)).cast("int"), place)
        return value

    values = distinct.select(F.posexplode(F.array(*map(packed, groups))).alias("chunk", "value"))
    counts = [np.zeros(1 << len(g)) for g in groups]
    for row in values.groupBy("chunk", "value").agg(F.count(F.lit(1)).alias("n")).toLocalIterator():
        counts[row["chunk"]][row["value"]] = row["n"]
    out = []
    for group, count in zip(groups, counts):
        pairs = _hadamard(_hadamard(count) ** 2) / len(count)
        out.append(np.bincount(np.bitwise_count(np.arange(len(count))), weights=pairs, minlength=len(group) + 1))
    return out


def _hadamard(values: np.ndarray) -> np.ndarray:
    out, step = values.copy(), 1
    while step < len(out):
        halves = out.reshape(-1, 2, step)
        out = np.stack((halves[:, 0] + halves[:, 1], halves[:, 0] - halves[:, 1]), axis=1).ravel()
        step *= 2
    return out


@dataclass(frozen=True)
class Group:
    """Bits of a group and its threshold (0 or more)."""

    bits: tuple[int, ...]
    threshold: int

    @property
    def mask(self) -> int:
        return _signed(sum(1 << b for b in self.bits))

    @property
    def flips(self) -> list[int]:
        """Every difference within the threshold."""
        return [_signed(sum(1 << b for b in some)) for k in range(self.threshold + 1) for some in combinations(self.bits, k)]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _unions(chunks: int) -> list[list[list[int]]]:
    """All ways to unite chunks into groups."""
    if not chunks:
        return [[]]
    out = []
    for rest in _unions(chunks - 1):
        out.append([*rest, [chunks - 1]])
        out += [[*rest[:i], [*g, chunks - 1], *rest[i + 1 :]] for i, g in enumerate(rest)]
    return out


def allocate(widths: list[int], pairs: list[np.ndarray], n: float, distance: int) -> tuple[float, list[int]]:
    """Thresholds, -1 or more, that add up to distance - m + 1 at the least estimated cost, and that cost."""

    def cost(i: int, t: int) -> float:
        if t < 0:
            return 0.0
        probes = n * (1 + sum(comb(widths[i], k) for k in range(t + 1)))
        return PROBE_COST * probes + PAIR_COST * float(pairs[i][: t + 1].sum())

    @lru_cache(maxsize=None)
    def best(i: int, left: int) -> tuple[float, tuple[int, ...]]:
        """For groups i and later, with ``left`` of the sum of (threshold + 1) still to give."""
        if i == len(widths):
            return (0.0, ()) if left == 0 else (float("inf"), ())
        options = []
        for t in range(-1, min(left, widths[i] + 1)):
            rest = best(i + 1, left - t - 1)
            options.append((cost(i, t) + rest[0], (t, *rest[1])))
        return min(options)

    total, thresholds = best(0, distance + 1)  # sum of (t_i + 1) = d - m + 1 + m
    return total, list(thresholds)


def plan(distinct: DataFrame, distance: int = DISTANCE) -> list[Group]:
    """Groups and thresholds for a self-join of the distinct fingerprints ``fp``."""
    n = distinct.count()
    chunks = bit_groups(distinct)
    counts = distance_counts(distinct, chunks)
    best: tuple[float, list[Group]] = (float("inf"), [])
    for union in _unions(len(chunks)):
        bits = [tuple(b for c in group for b in chunks[c]) for group in union]
        pairs = []
        for group in union:  # distances of united chunks add up, as if they were independent
            total = np.array([float(n) * n])
            for c in group:
                total = np.convolve(total, counts[c] / max(1.0, float(n) * n))
            pairs.append(total)
        cost, thresholds = allocate([len(b) for b in bits], pairs, n, distance)
        if cost < best[0]:
            best = (cost, [Group(b, t) for b, t in zip(bits, thresholds) if t >= 0])
    return best[1]


def _key(group: int, fp: Column, mask: int) -> Column:
    return F.struct(F.lit(group).alias("g"), fp.bitwiseAND(F.lit(mask)).alias("v"))


def links(distinct: DataFrame, groups: list[Group], distance: int = DISTANCE, split_above: int = SPLIT_ABOVE) -> DataFrame:
    """Pairs (a, b), a < b, of fingerprints that differ in at most ``distance`` bits; a pair may come more than once.

    A (group, value) that more than ``split_above`` fingerprints share is divided by the bits outside the group: cut into
    distance + 1 parts, of which one must be equal. The check on all bits is part of the join, so candidates are not written.
    """
    data = distinct.select("fp", F.explode(F.array(*(_key(i, F.col("fp"), g.mask) for i, g in enumerate(groups)))).alias("key"))
    data = data.select("fp", "key.g", "key.v")
    probes = data
    if any(g.threshold for g in groups):
        flips = F.broadcast(distinct.sparkSession.createDataFrame([(i, f) for i, g in enumerate(groups) for f in g.flips], "g int, flip long"))
        probes = data.join(flips, "g").select("fp", "g", F.col("v").bitwiseXOR(F.col("flip")).alias("v"))
    hot = materialise(data.groupBy("g", "v").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > split_above).select("g", "v", F.lit(True).alias("hot")), "hot")
    if hot.limit(1).count():
        data, probes = (_divided(side.join(hot, ["g", "v"], "left"), groups, distance) for side in (data, probes))
    else:
        data, probes = (side.withColumn("part", F.lit(-1)).withColumn("rest", F.lit(0).cast("long")) for side in (data, probes))
    a, b = probes.alias("a"), data.alias("b")
    same = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in ("g", "v", "part", "rest")]
    near = F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp"))) <= distance
    return a.join(b, [*same, F.col("a.fp") < F.col("b.fp"), near]).select(F.col("a.fp").alias("a"), F.col("b.fp").alias("b"))


def _divided(side: DataFrame, groups: list[Group], distance: int) -> DataFrame:
    """Adds (part, rest): for rows of hot keys one row per part of the bits outside their group, else (-1, 0)."""
    cases = F.array(F.struct(F.lit(-1).alias("part"), F.lit(0).cast("long").alias("rest")))
    parts = cases
    for i, group in enumerate(groups):
        outside = [b for b in range(BITS) if b not in group.bits]
        masks = [_signed(sum(1 << b for b in part)) for part in np.array_split(np.array(outside, object), distance + 1)]
        each = F.array(*(F.struct(F.lit(p).alias("part"), F.col("fp").bitwiseAND(F.lit(m)).alias("rest")) for p, m in enumerate(masks)))
        parts = F.when(F.col("hot") & (F.col("g") == i), each).otherwise(parts)
    return side.select("fp", "g", "v", F.explode(parts).alias("p")).select("fp", "g", "v", "p.part", "p.rest")


def classes(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, split_above: int = SPLIT_ABOVE) -> DataFrame:
    """doc_id, version, fp and component_id of each row of ``docs`` (doc_id, text).

    ``component_id`` is the smallest doc_id that a chain of links reaches, the row's own included; null ids are left out of
    it unless there are no others. Texts without words have fingerprint 0 and are linked like any other.
    """
    rows = materialise(fingerprints(docs.withColumn("version", row_version(F.col("text"))), shingle, ("doc_id", "version")), "fingerprints")
    distinct = materialise(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    groups = plan(distinct, distance)
    if not groups:  # an empty table
        return rows.withColumn("component_id", F.col("doc_id"))
    roots = components(links(distinct, groups, distance, split_above))
    rooted = distinct.join(roots, distinct["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = materialise(rooted.join(least, "root").select("fp", "component_id"), "named")
    return rows.join(named, "fp")


def near_duplicates(df: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Per row: doc_id, fingerprint (16 hex digits), component_id. Null texts are empty; further columns are left behind."""
    made = classes(documents(df, doc_id, text), shingle, distance, **options)
    return made.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(df: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row of each component of near-duplicates, all columns unchanged: that of the smallest doc_id.

    Among several rows with that id the smallest hash of the text stays; of rows equal in id and text, one. Rows without id
    in a component without any id count as one component per fingerprint. Rows to go are named by id and hash, so texts
    move only where these are too many to broadcast.
    """
    made = classes(documents(df, doc_id, text), shingle, distance, **options)
    heads = made.filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    group = ["doc_id", F.when(F.col("doc_id").isNull(), F.col("fp")).alias("lone")]
    tied = materialise(heads.groupBy(*group).agg(F.min("version").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"), "tied")
    out = made.filter(~F.col("doc_id").eqNullSafe(F.col("component_id"))).select("doc_id", "version")
    any_tied = tied.limit(1).count() > 0
    if any_tied:
        lone = F.when(heads["doc_id"].isNull(), heads["fp"])
        beside = heads.join(tied, heads["doc_id"].eqNullSafe(tied["doc_id"]) & lone.eqNullSafe(tied["lone"]))
        out = out.union(beside.filter(F.col("version") > F.col("first")).select(heads["doc_id"], "version"))
    id_, version = free_name(df, "gone_id"), free_name(df, "text_version")
    gone = materialise(out.select(F.col("doc_id").alias(id_), F.col("version").alias(f"{version}_")).distinct(), "gone")
    keyed = df.withColumn(version, row_version(text_of(text)))
    stay = keyed.join(gone, quoted(doc_id).eqNullSafe(quoted(id_)) & (quoted(version) == quoted(f"{version}_")), "left_anti")
    if any_tied:
        stay = stay.dropDuplicates([doc_id, version])
    return stay.select(*map(quoted, df.columns))

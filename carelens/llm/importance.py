"""Importance resampling of documents: hashed n-gram models of target text and raw text, sampled by Gumbel top-k.

A document's log weight is the sum, over its n-grams, of log p_target - log p_raw of their buckets. Adding Gumbel noise
to the log weights and keeping the k largest draws k documents without replacement, each with probability in proportion
to its weight. The raw model counts all n-grams of all documents; the target model those of the documents labelled good.

As a filter, k is the number of documents whose weight is at least 1 after a margin per n-gram, fitted on labelled rows, has
been taken off. Noise then decides only between documents whose n-grams say nearly nothing, such as very short ones.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelens.llm.common import blocks, documents, free_name, map_texts, quoted, release, row_version, text_of
from carelens.llm.hashing import BY_KIND, joined, mix, words
from carelens.session import materialise

#: Hash buckets of the n-gram models (a power of two); the models are collected, so this bounds them.
BUCKETS = 1 << 13
#: Labelled documents used at most, those with the smallest hash of their id.
MAX_LABELLED = 20_000
SEED = 42
_REPEAT = np.uint64(0x5BD1E995)


def features(texts: list[bytes], buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Text number and bucket of each n-gram: words and signs one by one, and neighbouring pairs.

    Letters A-Z count as a-z. A pair of equal words is one feature whatever the word, so that repetition shows.
    """
    data, begins = joined(texts)
    at, one = words(data, BY_KIND)
    text = np.searchsorted(begins, at, side="right") - 1
    two = mix(one[:-1] * np.uint64(0xD6E8FEB86659FD93) + one[1:])
    two[one[:-1] == one[1:]] = _REPEAT
    inside = text[:-1] == text[1:]
    shift = np.uint64(65 - buckets.bit_length())
    bucket = np.concatenate((mix(one) >> shift, mix(two[inside] ^ np.uint64(SEED)) >> shift))
    return np.concatenate((text, text[:-1][inside])), bucket.astype(np.int64)


@dataclass(frozen=True)
class Model:
    """``log_ratio`` of each bucket, and the ``margin`` taken off for each n-gram."""

    log_ratio: np.ndarray
    margin: float = 0.0

    def sums(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Sum of log ratios, and number of n-grams, of each text."""
        total, count = np.zeros(len(texts)), np.zeros(len(texts), np.int64)
        for a, b in blocks(texts, 1 << 19):
            text, bucket = features(texts[a:b], len(self.log_ratio))
            total[a:b] = np.bincount(text, self.log_ratio[bucket], b - a)
            count[a:b] = np.bincount(text, minlength=b - a)
        return total, count


def labelled(labels: DataFrame, limit: int = MAX_LABELLED) -> DataFrame:
    """doc_id and ``good`` (0/1) of at most ``limit`` labelled documents: the smallest hashes of the id, so the same ones
    whenever the labels are the same. Rows without id or label are left out; several labels of a document: the lowest counts.
    """
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("good")).dropna()
    rows = rows.groupBy("doc_id").agg(F.min("good").alias("good"))
    return rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)


def fit(docs: DataFrame, sample: DataFrame, buckets: int = BUCKETS) -> Model:
    """Count n-grams of all ``docs`` (doc_id, text) and of those labelled good, in one pass, and build the model.

    Each task adds up its own counts and hands on at most ``buckets`` rows; their sums, ``buckets`` rows, are collected.
    With no documents, or none labelled good, all ratios are 0.
    """
    marked = docs.join(F.broadcast(sample), "doc_id", "left").select("text", F.coalesce(F.col("good") == 1, F.lit(False)).alias("good"))

    def count(batches):
        release()
        sums = np.zeros((2, buckets), np.int64)
        for batch in batches:
            texts = [t.encode("utf-8", "replace") for t in batch.column(0).to_pylist()]
            good = np.asarray(batch.column(1).to_pylist(), bool)
            for a, b in blocks(texts, 1 << 19):
                text, bucket = features(texts[a:b], buckets)
                sums[0] += np.bincount(bucket, minlength=buckets)
                sums[1] += np.bincount(bucket[good[a:b][text]], minlength=buckets)
        used = np.flatnonzero(sums[0])
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(sums[0][used]), pa.array(sums[1][used])], ["bucket", "raw", "target"])

    rows = marked.mapInArrow(count, "bucket long, raw long, target long").groupBy("bucket").agg(
        F.sum("raw").alias("raw"), F.sum("target").alias("target")
    )
    raw, target = np.zeros(buckets), np.zeros(buckets)
    for row in rows.toLocalIterator():
        raw[row["bucket"]], target[row["bucket"]] = row["raw"], row["target"]
    if not target.sum():
        return Model(np.zeros(buckets))
    smooth = lambda c: np.log((c + 1) / (c.sum() + buckets))
    return Model(smooth(target) - smooth(raw))


def margin(scored: DataFrame, sample: DataFrame) -> float:
    """The mean log ratio per n-gram that best parts good from bad labelled documents (0 if a kind is missing).

    Collects one pair of numbers for each labelled document, so at most :data:`MAX_LABELLED`.
    """
    rows = scored.filter("n_grams > 0").join(F.broadcast(sample), "doc_id").select("doc_id", F.expr("log_ratio / n_grams").alias("mean"), "good")
    pairs = np.array([(r["mean"], r["good"]) for r in rows.dropDuplicates(["doc_id"]).collect()]).reshape(-1, 2)
    pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
    good = pairs[:, 1] == 1
    if good.all() or not good.any():
        return 0.0
    # cut between i - 1 and i: errors are good ones below and bad ones above, each as a share of its kind
    below_good = np.concatenate(([0], np.cumsum(good))) / good.sum()
    above_bad = 1 - np.concatenate(([0], np.cumsum(~good))) / (~good).sum()
    cuts = np.concatenate(([pairs[0, 0]], (pairs[1:, 0] + pairs[:-1, 0]) / 2, [pairs[-1, 0]]))
    cost = below_good + above_bad
    best = np.flatnonzero(cost <= cost.min() + 1e-12)
    # the widest gap among the best cuts, on the lenient side: clean documents are to stay
    gaps = [pairs[min(i, len(pairs) - 1), 0] - pairs[max(i - 1, 0), 0] for i in best]
    return float(cuts[best[int(np.argmax(gaps))]])


def gumbel(doc_id: Column, version: Column, seed: int = SEED) -> Column:
    """Gumbel noise that depends on the row only, so a task that runs again draws the same."""
    share = (F.xxhash64(F.lit(seed), doc_id, version).bitwiseAND(F.lit((1 << 52) - 1)).cast("double") + 0.5) / float(1 << 52)
    return -F.log(-F.log(share))


def kth_largest(df: DataFrame, column: str, k: int, bins: int = 4096) -> float | None:
    """The exact k-th largest value (counting equal ones each) of a column without nulls; None for k < 1 or an empty table.

    Counts per bin, then looks only into the bin that holds it, until that bin has a single value: no sort, and at most
    ``bins`` rows reach the driver in each round.
    """
    if k < 1:
        return None
    low, high, rows = df.agg(F.min(column), F.max(column), F.count(column)).first()
    if not rows:
        return None
    if k >= rows:
        return low
    left = k
    while low < high:
        width = (high - low) / bins
        place = F.least(F.floor((F.col(column) - low) / width), F.lit(bins - 1)).cast("int") if width > 0 else (F.col(column) >= high).cast("int")
        found = df.filter(F.col(column).between(low, high)).groupBy(place.alias("bin")).agg(
            F.count(F.lit(1)).alias("n"), F.min(column).alias("low"), F.max(column).alias("high")
        )
        for row in sorted(found.collect(), key=lambda r: -r["bin"]):
            if left <= row["n"]:
                low, high = row["low"], row["high"]
                break
            left -= row["n"]
    return low


def _scores(docs: DataFrame, model: Model, keep: tuple[str, ...], names: tuple[str, str]) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(model.log_ratio)

    def run(texts):
        total, count = Model(shared.value).sums([t.encode("utf-8", "replace") for t in texts])
        return {names[0]: total, names[1]: count}

    return map_texts(docs, run, f"{names[0]} double, {names[1]} long", keep)


@dataclass(frozen=True)
class Fitted:
    """A model with its ``cutoff``: the k-th largest key. ``scored``: doc_id, version, log_ratio, n_grams, log_weight, key."""

    model: Model
    k: int
    cutoff: float | None
    scored: DataFrame


def _key(doc_id: Column, version: Column, log_ratio: Column, n_grams: Column, margin: float) -> tuple[Column, Column]:
    weight = log_ratio - n_grams * F.lit(margin)
    return weight, weight + gumbel(doc_id, version)


def resample(docs: DataFrame, labels: DataFrame, k: int | None = None, buckets: int = BUCKETS, max_labelled: int = MAX_LABELLED) -> Fitted:
    """Fit on ``docs`` (doc_id, text) and draw ``k`` rows (default: as many as have a weight of 1 or more).

    Rows without a word have weight 1. Rows equal in id and text have equal keys and stay or go together, also where that is one more
    than k. Null texts count as empty; null ids are an id like any other, without label. An empty table draws nothing.
    """
    sample = materialise(labelled(labels, max_labelled), "labelled")
    model = fit(docs, sample, buckets)
    with_version = docs.withColumn("version", row_version(F.col("text")))
    scored = materialise(_scores(with_version, model, ("doc_id", "version"), ("log_ratio", "n_grams")), "scores")
    model = Model(model.log_ratio, margin(scored, sample))
    weight, key = _key(F.col("doc_id"), F.col("version"), F.col("log_ratio"), F.col("n_grams"), model.margin)
    scored = scored.select("*", weight.alias("log_weight"), key.alias("key"))
    if k is None:
        k = scored.filter("log_weight >= 0").count()
    return Fitted(model, k, kth_largest(scored, "key", k), scored)


def classify(df: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row per document: doc_id, log_ratio, n_grams, log_weight, key, kept."""
    fitted = resample(documents(df, doc_id, text), labels, **options)
    kept = F.lit(False) if fitted.cutoff is None else F.col("key") >= fitted.cutoff
    return fitted.scored.select("doc_id", "log_ratio", "n_grams", "log_weight", "key", kept.alias("kept"))


def keep_good(df: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``df``, all columns unchanged, that the resampling keeps.

    Texts are scored again in place rather than joined, so no text is moved.
    """
    fitted = resample(documents(df, doc_id, text), labels, **options)
    if fitted.cutoff is None:
        return df.limit(0)
    ratio, grams, whole = (free_name(df, c) for c in ("log_ratio", "n_grams", "whole_text"))
    with_text = df.withColumn(whole, text_of(text))
    scored = _rows_with_scores(with_text, whole, fitted.model, (ratio, grams))
    _, key = _key(quoted(doc_id), row_version(quoted(whole)), quoted(ratio), quoted(grams), fitted.model.margin)
    return scored.filter(key >= fitted.cutoff).select(*map(quoted, df.columns))


def _rows_with_scores(df: DataFrame, text: str, model: Model, names: tuple[str, str]) -> DataFrame:
    shared = df.sparkSession.sparkContext.broadcast(model.log_ratio)
    kind = T.StructType([T.StructField("total", T.DoubleType()), T.StructField("count", T.LongType())])

    @F.pandas_udf(kind)
    def score(texts):
        import pandas as pd

        total, count = Model(shared.value).sums([t.encode("utf-8", "replace") for t in texts])
        return pd.DataFrame({"total": total, "count": count})

    pair = free_name(df, "scores")
    out = df.withColumn(pair, score(quoted(text)))
    return out.withColumn(names[0], quoted(pair)["total"]).withColumn(names[1], quoted(pair)["count"])

"""Benchmark decontamination as a prefix-filtered set join, in DataFrame functions only.

A window is a run of ``window`` words of a benchmark item (all of a shorter item). To contain a window a text must contain
all its shingles, so it is enough to look for one of them: the prefix of length 1 under a global order. The order is by
rarity over all documents, so that the prefix shingle of each window is the one that gives the fewest candidates. A
candidate fixes where the window would begin; it must lie inside the text (position and length bounds), and the words
there are compared one by one.

The hashes of the shingles to look for are a few numbers per benchmark window. Up to :data:`BROADCAST` of them are sent to
all tasks, so that document positions are tested where they are made; beyond that they are joined by shuffle. Only positions that
match are written, with the few words around them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelens.llm.common import documents, free_name, quoted, row_version, text_of
from carelens.session import materialise

WINDOW = 10
SHINGLE = 3
#: Shingle hashes (8 bytes each) that are broadcast at most; counted first.
BROADCAST = 1 << 20

_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    """Words of a text: runs of a-z (A-Z lowered), digits and non-ASCII characters."""
    return F.array_remove(F.split(F.translate(text, _UPPER, _LOWER), _SEPARATORS), "")


def _shingle_at(words: Column, position: Column, size: int) -> Column:
    """Hash of the ``size`` words from ``position`` (from 0)."""
    return F.xxhash64(*(F.get(words, position + i) for i in range(size)))


def windows(items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """One row per distinct window: words, key (its hash), size, and its shingles (offset, hash).

    Items without words have none. A window shorter than the shingle length is its own shingle.
    """
    listed = items.select("words").filter(F.size("words") > 0).select(
        F.explode(
            F.transform(
                F.sequence(F.lit(0), F.greatest(F.size("words") - window, F.lit(0))),
                lambda i: F.slice("words", i + 1, window),
            )
        ).alias("words")
    )
    sized = listed.distinct().select("words", F.xxhash64("words").alias("key"), F.size("words").alias("size"))
    size = F.least(F.col("size"), F.lit(shingle))
    return sized.select("*", size.alias("shingle")).select(
        "*",
        F.transform(
            F.sequence(F.lit(0), F.col("size") - F.col("shingle")),
            lambda i: F.struct(i.alias("offset"), F.xxhash64(F.slice("words", i + 1, F.col("shingle"))).alias("hash")),
        ).alias("shingles"),
    )


def _positions(docs: DataFrame, hashes: DataFrame, size: int, kept: tuple[str, ...], context: int, broadcast: int) -> DataFrame:
    """Positions whose shingle of ``size`` words is among ``hashes``: ``kept`` columns, at, hash and, with ``context``, the
    words from ``context`` before to ``context`` after (``around``, beginning at word ``from``)."""
    enough = F.size("words") >= size
    at = docs.select(*kept, "words", F.explode(F.when(enough, F.sequence(F.lit(0), F.size("words") - size))).alias("at"))
    hashed = at.select("*", _shingle_at(F.col("words"), F.col("at"), size).alias("hash"))
    begin = F.greatest(F.col("at") - context, F.lit(0))
    near = [begin.alias("from"), F.slice("words", begin + 1, 2 * context + size).alias("around")] if context else []
    if hashes.count() <= broadcast:
        return hashed.join(F.broadcast(hashes), "hash", "left_semi").select(*kept, "at", "hash", *near)
    return hashed.select(*kept, "at", "hash", *near).join(hashes, "hash", "left_semi")


def _words_table(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    docs = documents(df, doc_id, text)
    return docs.select("doc_id", row_version(F.col("text")).alias("version"), words_of(F.col("text")).alias("words"))


def occurrences(df: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE, doc_id: str = "doc_id", text: str = "text",
                broadcast: int = BROADCAST) -> DataFrame:
    """Where windows occur: doc_id, version, start (word number from 0), size, key. ``items`` holds arrays ``words``."""
    table = materialise(windows(items, window, shingle), "windows")
    sizes = [r["shingle"] for r in table.select("shingle").distinct().collect()]  # 1 to `shingle`
    parts = []
    for size in sorted(sizes):
        own = table.filter(F.col("shingle") == size)
        exploded = own.select("key", "words", "size", F.explode("shingles").alias("s")).select("key", "words", "size", "s.offset", "s.hash")
        docs = _words_table(df, doc_id, text)
        # rarity: how often each shingle of the benchmark occurs in all documents
        seen = _positions(docs, materialise(exploded.select("hash").distinct(), "hashes"), size, (), 0, broadcast)
        rarity = seen.groupBy("hash").agg(F.count(F.lit(1)).alias("n"))
        ranked = exploded.join(rarity, "hash", "left").groupBy("key").agg(
            F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), F.col("hash"), F.col("offset"), F.col("words"), F.col("size"))).alias("p")
        )
        # a window with a shingle that no document has cannot occur
        prefix = materialise(ranked.filter("p.n > 0").select("key", "p.hash", "p.offset", "p.words", "p.size"), "prefix")
        sought = materialise(prefix.select("hash").distinct(), "hashes")
        found = _positions(docs, sought, size, ("doc_id", "version"), window, broadcast)
        start = F.col("at") - F.col("offset")
        parts.append(
            found.join(prefix, "hash")
            .filter((start >= 0) & (start - F.col("from") + F.col("size") <= F.size("around")))
            .filter(F.expr("slice(around, at - offset - `from` + 1, size) = words"))
            .select("doc_id", "version", start.alias("start"), "size", "key")
        )
    if not parts:
        return df.sparkSession.createDataFrame([], "version long, start int, size int, key long").withColumn(
            "doc_id", F.lit(None).cast(df.schema[doc_id].dataType)
        ).select("doc_id", "version", "start", "size", "key")
    return reduce(DataFrame.union, parts)


def _items(benchmark: DataFrame, item_id: str, text: str) -> DataFrame:
    return benchmark.select(quoted(item_id).alias("item_id"), words_of(text_of(text)).alias("words"))


def hits(df: DataFrame, benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE, doc_id: str = "doc_id", text: str = "text",
         item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """Per text with an occurrence: doc_id, version, n_hit, n_items, items (sorted strings)."""
    items = materialise(_items(benchmark, item_id, item_text), "items")
    found = materialise(occurrences(df, items, window, shingle, doc_id, text), "occurrences")
    covered = found.select("doc_id", "version", F.explode(F.sequence(F.col("start"), F.col("start") + F.col("size") - 1)).alias("at")).distinct()
    n_hit = covered.groupBy("doc_id", "version").agg(F.count(F.lit(1)).alias("n_hit"))
    listed = items.filter(F.size("words") > 0).select(
        F.col("item_id").cast("string").alias("item"),
        F.explode(F.transform(F.sequence(F.lit(0), F.greatest(F.size("words") - window, F.lit(0))), lambda i: F.xxhash64(F.slice("words", i + 1, window)))).alias("key"),
    ).distinct()
    by_item = found.select("doc_id", "version", "key").distinct().join(listed, "key").select("doc_id", "version", "item").distinct()
    n_items = by_item.groupBy("doc_id", "version").agg(F.count(F.lit(1)).alias("n_items"), F.sort_array(F.collect_list("item")).alias("items"))
    i = n_items.select(F.col("doc_id").alias("i_id"), F.col("version").alias("i_version"), "n_items", "items")
    return n_hit.join(i, n_hit["doc_id"].eqNullSafe(F.col("i_id")) & (n_hit["version"] == F.col("i_version")), "left").select(
        "doc_id", "version", "n_hit", F.coalesce("n_items", F.lit(0)).alias("n_items"), F.coalesce("items", F.array().cast("array<string>")).alias("items")
    )


def contamination(df: DataFrame, benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE, doc_id: str = "doc_id", text: str = "text",
                  item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """Per row: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    Null texts have no words; null item texts no windows. Items with equal texts each count; a null item_id is counted but
    not listed in the digest. Repeated rows get equal results each. Null doc_ids are an id like any other.
    """
    found = materialise(hits(df, benchmark, window, shingle, doc_id, text, item_id, item_text), "hits")
    docs = documents(df, doc_id, text).select("doc_id", row_version(F.col("text")).alias("version"), F.size(words_of(F.col("text"))).cast("long").alias("n_words"))
    right = found.select(F.col("doc_id").alias("h_id"), F.col("version").alias("h_version"), "n_hit", "n_items", "items")
    joined = docs.join(right, docs["doc_id"].eqNullSafe(F.col("h_id")) & (docs["version"] == F.col("h_version")), "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return joined.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.coalesce("items", F.array().cast("array<string>"))), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def keep_clean(df: DataFrame, benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE, doc_id: str = "doc_id", text: str = "text",
               item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of ``df``, all columns unchanged, in whose text no window occurs."""
    items = materialise(_items(benchmark, item_id, item_text), "items")
    found = occurrences(df, items, window, shingle, doc_id, text)
    id_, version = free_name(df, "hit_id"), free_name(df, "text_version")
    gone = materialise(found.select(F.col("doc_id").alias(id_), F.col("version").alias(f"{version}_")).distinct(), "contaminated")
    keyed = df.withColumn(version, row_version(text_of(text)))
    return keyed.join(gone, quoted(doc_id).eqNullSafe(quoted(id_)) & (quoted(version) == quoted(f"{version}_")), "left_anti").select(*map(quoted, df.columns))

"""Latest record per key, and deduplication."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from carelens.session import materialise


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Keep the first row of each key under ``order`` (give a total order for a stable result).

    Spark plans the ``= 1`` filter as a group limit ahead of the shuffle: each task keeps one row per key, so
    a hot key sends one row per input task.
    """
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def dedupe_business_rows(df: DataFrame, lineage: list[str]) -> DataFrame:
    """Collapse rows that agree on everything but ``lineage``, keeping the smallest lineage.

    Duplicates are combined before the shuffle, so many copies of one row do not meet in one task.
    """
    business = [c for c in df.columns if c not in lineage]
    return (
        df.groupBy(*business)
        .agg(F.min(F.struct(*lineage)).alias("_lineage"))
        .select(*[F.col(c) if c in business else F.col("_lineage").getField(c).alias(c) for c in df.columns])
    )


def first_copy_of_text(df: DataFrame, text: str, key: str) -> DataFrame:
    """One row per distinct text: its smallest ``key`` and the number of copies.

    Texts are compared by a 256-bit digest of the whole text, so the shuffle carries digests, not texts.
    """
    return (
        df.groupBy(F.sha2(F.col(text), 256).alias("digest"))
        .agg(F.min(key).alias(key), F.count(F.lit(1)).alias("copies"))
    )


def conflicting_keys(df: DataFrame, keys: list[str], lineage: list[str]) -> DataFrame:
    """Keys that occur with different content, and how many versions each has."""
    business = [c for c in df.columns if c not in lineage]
    return (
        df.select(*business)
        .distinct()
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("versions"))
        .filter("versions > 1")
    )


class KeyedState:
    """Rows kept per key under ``path`` and merged with what arrives, instead of reading all deliveries again.

    Keys are dealt to ``buckets`` by a hash. A merge reads and rewrites only the buckets of the keys that arrived, as a new version; a row of
    the log then makes the version valid, so a merge that fails changes nothing and can be repeated. One writer at a time.
    Subclasses say how arrived rows are prepared and combined with the kept ones of the same keys; deliveries may come in any
    order, late, or twice if that does not depend on it.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, keys: list[str], buckets: int = 64):
        self.spark, self.path, self.schema, self.keys, self.buckets = spark, path, schema, keys, buckets

    def prepare(self, batch: DataFrame) -> DataFrame:
        return batch

    def combine(self, kept: DataFrame, arrived: DataFrame) -> DataFrame:
        raise NotImplementedError

    def versions(self) -> dict[int, int]:
        """The valid version of each bucket that holds anything: at most ``buckets`` numbers."""
        try:
            log = self.spark.read.schema("version long, bucket int").json(f"{self.path}/log")
            return {r["bucket"]: r["version"] for r in log.groupBy("bucket").agg(F.max("version").alias("version")).collect()}
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return {}

    def read(self, only: set[int] | None = None) -> DataFrame:
        """The kept rows, of some buckets or all."""
        empty = self.spark.createDataFrame([], self.schema)
        valid = {b: v for b, v in self.versions().items() if only is None or b in only}
        if not valid:
            return empty
        folders = [f"{self.path}/data/version={v}/bucket={b}" for b, v in sorted(valid.items())]
        return self.spark.read.schema(self.schema).parquet(*folders).select(*empty.columns)

    def merge(self, batch: DataFrame) -> set[int]:
        """Take over the rows of a delivery; returns the buckets that were rewritten."""
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        arrived = materialise(self.prepare(batch), "arrived")
        touched = {r["b"] for r in arrived.select(bucket.alias("b")).distinct().collect()}  # at most ``buckets``
        if touched:
            version = max(self.versions().values(), default=0) + 1
            rows = self.combine(self.read(touched), arrived).withColumn("bucket", bucket)
            rows.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/data/version={version}")
            log = self.spark.createDataFrame([(version, b) for b in sorted(touched)], "version long, bucket int")
            log.coalesce(1).write.mode("append").json(f"{self.path}/log")
        return touched


class LatestState(KeyedState):
    """One winner per key under a total order: a winner of winners is the winner of all."""

    def __init__(self, spark: SparkSession, path: str, schema: str, keys: list[str], order: list[Column], buckets: int = 64):
        super().__init__(spark, path, schema, keys, buckets)
        self.order = order

    def prepare(self, batch: DataFrame) -> DataFrame:
        return latest_per_key(batch, self.keys, self.order)

    def combine(self, kept: DataFrame, arrived: DataFrame) -> DataFrame:
        return latest_per_key(kept.unionByName(arrived), self.keys, self.order)

"""The pipeline's rows against its stages done by hand on the smallest tables, and the registered queries."""

from hashlib import sha256

import public_tokenizers
import tiktoken
from pyspark.sql import functions as F

import __spark_entry__ as registry
import corpus_pipeline
from carelens.llm import byte_bpe, importance, line_dedup, queries
from test_filters import brute_all_units, brute_contamination
from test_near_duplicates import brute_components, brute_fingerprint


SF = "/root/testdata/sf0.001"


def test_run_equals_the_stages_by_hand(spark):
    read = lambda t: spark.read.parquet(f"{SF}/{t}.parquet")
    rows = [(r.doc_id, r.text) for r in read("documents").collect()]
    good = {r.doc_id for r in importance.classify(read("documents"), read("labels")).filter("kept").collect()}
    rows = [r for r in rows if r[0] in good]
    roots = brute_components([(i, brute_fingerprint(t or "")) for i, t in rows])
    rows = [(i, t) for i, t in rows if roots[i] == i]
    spans = brute_all_units(rows, line_dedup.LINE_WORDS)
    rows = [(i, line_dedup.cut(t, spans.get((i, t), []))) for i, t in rows]
    items = [(r.item_id, r.text) for r in read("benchmark").collect()]
    dirty = {r[0] for r in brute_contamination(rows, items) if r[-1]}
    ranks = byte_bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    expected = {i: (library.encode_ordinary(t), sha256(t.encode()).hexdigest()) for i, t in rows if i not in dirty}
    got = {r.doc_id: (r.ids, r.decoded_sha256) for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == expected


def test_stages_keep_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(40).withColumn("text", F.when(F.col("doc_id") % 9 != 0, F.col("text")))
    docs = docs.withColumn("a.b", F.lit(1)).withColumn("version", F.lit("v")).withColumn("fp", F.lit(None).cast("string"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        for table in (docs, docs.limit(0)):
            out = stage(spark, table, SF)
            assert out.columns == docs.columns and out.count() <= table.count()
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), SF).count() == 0


def test_one_query_per_operator_over_whole_tables(spark):
    names = sorted(queries.QUERIES, key=lambda n: int(n[2:].split("_")[0]))
    assert [int(n[2:].split("_")[0]) for n in names] == list(range(1, 14))
    assert set(names) | {"pipeline"} <= set(registry.queries())
    for name in names:
        rows = registry.queries()[name](spark, SF)
        if name.startswith("op11_"):  # a row per word
            continue
        table = "pages" if name.startswith(("op6_", "op7_")) else "documents"
        assert rows.count() == spark.read.parquet(f"{SF}/{table}.parquet").count()

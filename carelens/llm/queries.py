"""One registered query per operator, over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelens.llm import alignment, block_labeller, byte_bpe, decontaminate, importance, line_dedup, simhash, sketches, spelling, suffix_dedup, token_counts, toxicity, warc
from carelens.llm.common import ship

QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def register(name: str, oracle: str | None = None):
    def add(build: Callable[[Callable[[str], DataFrame]], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return build(lambda table: spark.read.parquet(f"{sf_dir}/{table}.parquet"))

        QUERIES[name] = (run, oracle)
        return build

    return add


def tokenizer_file(name: str) -> str:
    """Where a public vocabulary lies on the driver; executors get its content by broadcast."""
    import public_tokenizers

    return public_tokenizers.path(name)


def tokenizer_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


@register("op1_importance_resampling")
def _importance(table):
    return importance.classify(table("documents"), table("labels"))


@register("op2_token_counts")
def _token_counts(table):
    vocabulary = token_counts.load_vocabulary(tokenizer_file("byte_bpe_50k.json"), tokenizer_pattern())
    return token_counts.token_counts(table("documents"), vocabulary)


@register("op3_line_dedup")
def _line_dedup(table):
    out = line_dedup.remove_repeats(table("documents").select("doc_id", "text"), line_words=line_dedup.LINE_WORDS)
    return out.select("doc_id", "text", "removed", F.size("removed").cast("long").alias("n_removed"))


@register("op4_simhash_near_dedup")
def _simhash(table):
    return simhash.near_duplicates(table("documents"))


DECONTAMINATION_SQL = r"""
WITH item AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
start_of AS (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM item WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + 9], ' ') AS s FROM start_of),
size_of AS (SELECT DISTINCT n FROM win),
place AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc, size_of WHERE len(w) >= n),
run AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS s FROM place),
found AS (SELECT run.doc_id, run.i, run.n, win.item_id FROM run JOIN win USING (n, s)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM found) GROUP BY doc_id),
named AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
                 array_to_string(list_sort(list(DISTINCT CAST(item_id AS VARCHAR))), ',') AS items FROM found GROUP BY doc_id)
SELECT doc.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""


@register("op5_decontamination", DECONTAMINATION_SQL)
def _decontamination(table):
    return decontaminate.contamination(table("documents"), table("benchmark"))


@register("op9_byte_bpe")
def _byte_bpe(table):
    ranks = byte_bpe.load_ranks(tokenizer_file("byte_bpe_multi_50k.tiktoken"))
    return byte_bpe.round_trip(table("documents"), ranks, tokenizer_pattern())


@register("op10_bottom_k")
def _bottom_k(table):
    return sketches.edited_copies(table("documents"))


WARC_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b) AS n, sha256(b) AS h FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first_id FROM d)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, h AS payload_digest,
       CASE WHEN n >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM f
"""


@register("op6_warc", WARC_SQL)
def _warc(table):
    return warc.round_trip(table("pages"))


@register("op8_toxicity_chain")
def _toxicity(table):
    return toxicity.classify(table("documents"), table("labels"))


@register("op7_block_labeller")
def _block_labeller(table):
    return block_labeller.main_text(table("pages"))


@register("op12_suffix_dedup")
def _suffix_dedup(table):
    out = suffix_dedup.remove_repeats(table("documents").select("doc_id", "text"))
    return out.select(
        "doc_id",
        (F.octet_length(F.coalesce("text", F.lit("")))).cast("long").alias("n_bytes"),
        (F.octet_length(F.coalesce("text", F.lit(""))) - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@register("op13_alignment")
def _alignment(table):
    files = (tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model"))
    return alignment.align_documents(table("documents"), alignment.Vocabularies.load(*files))


SPELLING_SQL = r"""
WITH RECURSIVE crc_table AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
    FROM (SELECT unnest(range(256)) AS i))),
runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[A-Za-z\x{C0}-\x{FF}]+')) AS run FROM documents),
per_doc AS (SELECT doc_id, run, count(*) AS n FROM runs GROUP BY ALL),
bytes_of AS (
  SELECT doc_id, run, n, flatten(list_transform(string_split(CAST(doc_id AS VARCHAR) || ':' || run, ''), lambda c:
    CASE WHEN unicode(c) < 128 THEN [CAST(unicode(c) AS BIGINT)] ELSE [195, CAST(unicode(c) - 64 AS BIGINT)] END)) AS b FROM per_doc),
hashed AS (
  SELECT run, n, xor(list_reduce(list_prepend(4294967295, b), lambda c, x: xor(c >> 8, t[xor(c, x) % 256 + 1])), 4294967295) AS h
  FROM bytes_of, crc_table),
taken AS (
  SELECT n, CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM hashed),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM taken WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
cut AS (
  SELECT word, n, i, length(word) AS len, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM cut a JOIN cut b USING (i, len, rest) WHERE a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cut a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM cut a JOIN words b ON a.rest = b.word),
counted AS (SELECT word, count(*) AS n_near FROM near GROUP BY word),
top AS (SELECT word, other, other_n FROM near QUALIFY row_number() OVER (PARTITION BY word ORDER BY other_n DESC, encode(other)) = 1),
known AS (
  SELECT w.word, w.n, CAST(coalesce(c.n_near, 0) AS BIGINT) AS n_near,
         CASE WHEN t.other_n >= 2 * w.n THEN t.other END AS form, CASE WHEN t.other_n >= 2 * w.n THEN t.other_n END AS form_n
  FROM words w LEFT JOIN counted c USING (word) LEFT JOIN top t USING (word)),
path AS (
  SELECT word, word AS here, form FROM known
  UNION ALL SELECT p.word, k.word, k.form FROM path p JOIN known k ON k.word = p.form)
SELECT k.word, k.n, k.n_near, k.form, k.form_n, p.here AS root FROM known k JOIN path p ON p.word = k.word AND p.form IS NULL
"""


@register("op11_spelling_variants", SPELLING_SQL)
def _spelling(table):
    return spelling.group_variants(spelling.words(table("documents"), every=97))

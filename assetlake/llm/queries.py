"""The corpus operators' queries with production parameters, one per operator, and the pipeline."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from assetlake.llm import (
    embedding_dedup,
    exact_dedup,
    hard_negatives,
    langid,
    lm_scoring,
    main_text,
    mixing,
    packing,
    sharding,
    simhash,
    spelling,
    substring_dedup,
    token_counts,
)
from assetlake.llm.common import crc32_utf8, whole
from assetlake.plans.registry import Tables
from assetlake.session import prepare

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
BYTE_BPE, WORD_BPE = "byte_bpe_50k.json", "word_bpe_49k.json"


def query(name: str, sql: str | None = None):
    def register(fn):
        def run(spark, sf_dir):
            prepare(spark)
            return fn(Tables(spark, sf_dir))

        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


@query("op1_lm_scoring")
def op1(t):
    """Log-bilinear and unigram scores of every document."""
    return lm_scoring.score(t("documents"))


@query("op2_token_counts")
def op2(t):
    """Byte-level BPE tokens of every document."""
    return token_counts.token_counts(t("documents"), public_tokenizers.path(BYTE_BPE))


EXACT_SQL = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
FROM d WINDOW w AS (PARTITION BY norm)
"""


@query("op3_exact_dedup", EXACT_SQL)
def op3(t):
    """Groups of equal texts."""
    docs = t("documents").select("doc_id", "text")
    hashed = docs.withColumn("text_sha256", exact_dedup.full_hash("text"))
    return exact_dedup.exact_groups(hashed, carry=["text_sha256"])


@query("op4_simhash_dedup")
def op4(t):
    """SimHash fingerprints and their components."""
    found = simhash.simhash_components(t("documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query("op5_substring_dedup")
def op5(t):
    """Words left of every document once repeated passages are removed."""
    left = substring_dedup.substring_dedup(t("documents"))
    return left.select("doc_id", "n_words", "n_removed", F.sha2(F.encode("kept_text", "UTF-8"), 256).alias("kept_sha256"))


@query("op6_sharding")
def op6(t):
    """Forty shards by a two-pass shuffle; row counts differ by one at most."""
    size = (F.octet_length(whole("text")) + 16).cast("long")
    docs = t("documents").select("doc_id", "text", size.alias("size"), crc32_utf8("text").alias("text_crc32"))
    placed = sharding.shard(docs, 40)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit(sharding.LAW).alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query("op7_embedding_dedup")
def op7(t):
    """Links and components of the embeddings."""
    return embedding_dedup.embedding_components(t("embeddings"))


MIX_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5('mix-1/' || coalesce(doc_id::VARCHAR, '')) AS ord
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1)::INT]::DOUBLE AS weight,
             3 * source_size AS cap FROM s),
l AS (SELECT *, (sum(source_size) OVER ()
                 - coalesce(sum(cap) OVER (ORDER BY cap / weight, source IS NULL, source
                                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
               / sum(weight) OVER (ORDER BY cap / weight, source IS NULL, source
                                   ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
t AS (SELECT source, source_size, least(cap::DOUBLE, max(level) OVER () * weight) AS target FROM l),
p AS (SELECT source, source_size, target, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS reads FROM t),
c AS (SELECT d.*, p.source_size, p.target, p.reads,
             coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY ord, size
                                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target,
       (size * (CASE WHEN size > 0 THEN reads ELSE 0 END
                + CASE WHEN size > 0 AND 2 * before + size <= 2 * (target - reads * source_size) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM c
"""


@query("op8_mixing", MIX_SQL)
def op8(t):
    """Words that the mix takes from each document, in training order."""
    planned = mixing.plan_mix(t("documents").select("doc_id", "text", "source"), carry=["doc_id"])
    return mixing.mix_plan(planned).select("row.doc_id", "size", "source_size", "target", "taken")


@query("op9_best_fit_packing")
def op9(t):
    """Pieces of documents in sequences of 4096 tokens."""
    return packing.pack(t("documents"), public_tokenizers.path(WORD_BPE))


@query("op10_language_id")
def op10(t):
    """Predicted language of every document."""
    return langid.identify(t("documents"), carry=["doc_id"])


@query("op11_html_extraction")
def op11(t):
    """Main text of every page."""
    pages = t("pages")
    return main_text.extract(pages, main_text.train(pages), carry=["page_id", "url"])


SPELLING_SQL = r"""
WITH tab AS (
  SELECT list_transform(range(256), lambda b: list_reduce(range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b)) AS t),
runs AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')) AS run FROM documents)
  WHERE length(run) >= 7 GROUP BY ALL),
hashed AS (
  SELECT run, n, xor(list_reduce(
           flatten(list_transform(string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''),
             lambda c: CASE WHEN ord(c) < 128 THEN [ord(c)::BIGINT] ELSE [192 + (ord(c) >> 6), 128 + (ord(c) & 63)]::BIGINT[] END)),
           lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) AS h
  FROM runs, tab),
v AS MATERIALIZED (
  SELECT word, sum(n)::BIGINT AS n
  FROM (SELECT CASE WHEN h % 31 = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, n
        FROM hashed)
  WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
dels AS MATERIALIZED (
  SELECT word, n, i, left(word, i) || substr(word, i + 2) AS rest FROM (SELECT word, n, unnest(range(length(word)))::INT AS i FROM v)),
near AS (
  SELECT a.word, b.word AS other, b.n AS n FROM dels a JOIN dels b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION ALL SELECT DISTINCT d.word, v.word, v.n FROM dels d JOIN v ON d.rest = v.word
  UNION ALL SELECT DISTINCT v.word, d.word, d.n FROM dels d JOIN v ON d.rest = v.word),
best AS (
  SELECT word, count(*) AS n_near, first(other ORDER BY n DESC, other) AS form, max(n) AS form_n FROM near GROUP BY word),
told AS MATERIALIZED (
  SELECT v.word, v.n, CASE WHEN form_n >= 10 * v.n THEN form END AS form, coalesce(n_near, 0)::BIGINT AS n_near,
         CASE WHEN form_n >= 10 * v.n THEN form_n END::BIGINT AS form_n
  FROM v LEFT JOIN best USING (word)),
way AS (
  WITH RECURSIVE w AS (
    SELECT word, word AS here, 0 AS steps FROM told
    UNION ALL SELECT w.word, told.form, w.steps + 1 FROM w JOIN told ON told.word = w.here WHERE told.form IS NOT NULL)
  SELECT word, arg_max(here, steps) AS root FROM w GROUP BY word)
SELECT word, n, form, root, n_near, form_n FROM told JOIN way USING (word)
"""


@query("op12_spelling_variants", SPELLING_SQL)
def op12(t):
    """Spelling variants among the words of all documents."""
    return spelling.document_variants(t("documents"))


NEGATIVES_SQL = r"""
WITH r AS MATERIALIZED (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS MATERIALIZED (
  SELECT a.id AS anchor, r.id AS id, a.label = r.label AS same, list_dot_product(a.v, r.v)::BIGINT AS score
  FROM r a JOIN r ON a.id <> r.id WHERE a.id % 100 = 0),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, id) <= 5),
n AS (SELECT p.anchor, p.id AS positive, p.score AS positive_score, s.id, s.score,
             row_number() OVER (PARTITION BY p.anchor, p.id ORDER BY s.score DESC, s.id) AS rank
      FROM p JOIN s ON p.anchor = s.anchor AND NOT s.same
                   AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score)
SELECT anchor AS anchor_id, positive AS positive_id, rank::INT AS rank, id AS negative_id, positive_score, score AS negative_score
FROM n WHERE rank <= 10
"""


@query("op13_hard_negatives", NEGATIVES_SQL)
def op13(t):
    """Hard negatives of every hundredth embedding."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label").cast("long"))
    scaled = F.transform("embedding", lambda x: hard_negatives.floor_scaled(x, 256))
    rows = t("embeddings").select("vec_id", label.alias("label"), scaled.alias("embedding"))
    return hard_negatives.hard_negatives(rows)

"""Registered queries: each applies one operator to its whole table and derives the columns of its contract."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from logtide.llm import (collocations, embed_dedup, hard_negatives, html_text, language, mixing, packing, pii, secret_scan, sharding, shingle_join, topk,
                         toxicity)
from logtide.llm.common import documents, held_out
from logtide.llm.stages import run as pipeline, tokenizer_path
from logtide.sources.tables import table

def op1_topk(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op2_embed_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return embed_dedup.near_duplicates(table(spark, folder, "embeddings"), similarity=0.9)


def op3_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(documents(spark, folder))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op4_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(documents(spark, folder), tokenizer_path())


def op5_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    found = language.predict(docs, language.fit(docs, ~held_out()))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op6_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.digest_columns(pii.find_pii(documents(spark, folder)))


def op7_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return pii.digest_columns(secret_scan.find_secrets(documents(spark, folder)), secret_scan.KINDS, by_start=True)


def op8_sharding(spark: SparkSession, folder: str) -> DataFrame:
    placed = sharding.shard_rows(documents(spark, folder), shards=24)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op9_shingle_join(spark: SparkSession, folder: str) -> DataFrame:
    return shingle_join.component_ids(documents(spark, folder))


def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    found = toxicity.score(docs, toxicity.fit(docs, table(spark, folder, "labels"), ~held_out()))
    return found.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    vec_id, label = F.col("vec_id"), F.col("label")
    noisy = table(spark, folder, "embeddings").withColumn("label", F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label))
    return hard_negatives.mine(noisy, vec_id % 50 == 0)


def op12_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(documents(spark, folder))


def op13_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.main_text(table(spark, folder, "pages")).withColumn("n_chars", F.char_length("text").cast("long"))


QUERIES = {"pipeline": pipeline} | {f.__name__: f for f in (op1_topk, op2_embed_dedup, op3_mixing, op4_packing, op5_language, op6_pii, op7_secrets, op8_sharding,
                                   op9_shingle_join, op10_toxicity, op11_hard_negatives, op12_collocations, op13_main_text)}
ORACLES: dict[str, str] = {
    "op11_hard_negatives": """
WITH rows AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
    list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM rows a JOIN rows b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)),
positives AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, (row_number() OVER w)::INTEGER AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN pairs USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) QUALIFY rank <= 3""",
    "op12_collocations": r"""
WITH texts AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
pieces AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM texts),
lists AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM pieces),
sizes AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM lists GROUP BY lang),
runs AS (SELECT lang, unnest(flatten(list_transform([1, 2, 3, 4], lambda m: list_transform(range(1, len(ws) - m + 2), lambda i: ws[i:i + m - 1])))) AS w FROM lists),
f AS (SELECT lang, w, count(*) AS a FROM runs GROUP BY lang, w HAVING count(*) >= 30),
parts AS (SELECT lang, w[1:len(w) - 1] AS w, a FROM f WHERE len(w) > 2 UNION ALL SELECT lang, w[2:], a FROM f WHERE len(w) > 2),
above AS (SELECT lang, w, max(a) AS above FROM parts GROUP BY lang, w),
kept AS (SELECT f.lang, f.w, f.a FROM f LEFT JOIN above USING (lang, w) WHERE len(f.w) > 1 AND (above IS NULL OR 100 * above::HUGEINT < 80 * f.a::HUGEINT)),
cuts AS (SELECT lang, w, a, unnest(range(1, len(w))) AS k FROM kept),
scored AS (SELECT c.lang, c.w, c.a, c.k, x.a AS l, y.a AS r, (2000000 * c.a::HUGEINT) // (x.a + y.a) AS score FROM cuts c
  JOIN f x ON x.lang = c.lang AND x.w = c.w[1:c.k] JOIN f y ON y.lang = c.lang AND y.w = c.w[c.k + 1:]),
best AS (SELECT lang, w, a, min({'score': score, 'k': k, 'l': l, 'r': r}) AS b FROM scored GROUP BY lang, w, a),
named AS (SELECT lang, array_to_string(w, ' ') AS phrase, a, b.l AS l, b.r AS r, b.score AS score FROM best),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM named)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked JOIN sizes USING (lang) WHERE rank <= 2000""",
}

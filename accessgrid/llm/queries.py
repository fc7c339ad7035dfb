"""One query for each operator, over its whole table, and the SQL for those that SQL can express."""
from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accessgrid.llm import bpe, jaccard_join, licenses, lines, lm, merkle, mixing, oracles, pieces, quality, ready, sharding, topk, trie, warc
from accessgrid.llm.common import table

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
PIECES = "piece_bpe_32k.model"
SHARDS = [f"shard-{n:03d}" for n in range(64)]
#: Target weights by level; what isn't named has weight 1 among its siblings.
WEIGHTS = {
    "domain": {"d0": 4.0, "d1": 3.0, "d2": 2.0, "d3": 1.0},
    "language": {"en": 5.0, "de": 2.0, "fr": 2.0, "es": 1.0},
}


def jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_join(table(ready(spark), sf_dir, "documents"))


def archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.pages_round_trip(table(ready(spark), sf_dir, "pages"))


def search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(ready(spark), sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = lm.score(table(ready(spark), sf_dir, "documents"), ~lm.held_out("doc_id"))
    return scored.withColumn("held_out", ~F.col("training")).drop("training")


def tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(ready(spark), sf_dir, "documents")
    return bpe.round_trip(docs, "text", public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN, "doc_id")


def rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(ready(spark), sf_dir, "documents"), "doc_id", by_own_limits=True)


def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_dedup(table(spark, sf_dir, "documents"))


def mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), WEIGHTS).drop("key")


def shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sharding.through_shards(table(spark, sf_dir, "documents"), "doc_id", SHARDS)
    digests = [F.octet_length("text").alias("text_bytes"), F.sha2("text", 256).alias("text_sha256")]
    return found.select("doc_id", "lang", "source", "n_chars", "slot", "shard", "part", *digests)


def marked_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(ready(spark), sf_dir, "documents")
    return pieces.round_trip(docs, "text", public_tokenizers.path(PIECES), "doc_id")


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(table(ready(spark), sf_dir, "conversations"))


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verified_manifest(table(spark, sf_dir, "documents"))


def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_jaccard_join": jaccard,
    "op2_warc": archives,
    "op3_top_k": search,
    "op4_suffix_tree": suffix_tree,
    "op5_bpe": tokens,
    "op6_quality": rules,
    "op7_line_dedup": line_dedup,
    "op8_mixing": mixture,
    "op9_sharding": shards,
    "op10_licenses": license_scan,
    "op11_pieces": marked_words,
    "op12_trie": conversations,
    "op13_merkle": manifest,
}

ORACLES = {
    "op3_top_k": """
WITH v AS (
  SELECT vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_inner_product(CAST(q.e AS DOUBLE[]), CAST(c.e AS DOUBLE[])) AS BIGINT) AS score
  FROM (SELECT DISTINCT * FROM v WHERE vec_id % 100 = 0) q JOIN v c ON c.vec_id <> q.vec_id AND len(c.e) = len(q.e))
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 10""",
    "op12_trie": oracles.TRIE,
    "op13_merkle": oracles.MERKLE,
}

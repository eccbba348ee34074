"""The numbered queries, each a thin use of its operator, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (dart_minhash, graph_dedup, hard_negatives, langid, packing, rabitq, secret_scan, sharding, suffix_pieces, token_store, url_rules,
               whitening, word_bpe)
from .common import table


def op1_shard_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's slot and shard."""
    return sharding.place(table(spark, sf_dir, "documents").select("doc_id"), "doc_id")


def op2_secret_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    return secret_scan.secret_report(table(spark, sf_dir, "documents"))


def op3_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's near-duplicate class."""
    return dart_minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op4_language_family(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's predicted language."""
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs, "doc_id", "text", "lang")
    found = langid.identify(docs, model, "doc_id", "text")
    return found.select("doc_id", langid.held_out("doc_id").alias("held_out"), "lang_pred", "score")


def op5_rotated_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every 20th vector."""
    return rabitq.search(table(spark, sf_dir, "embeddings"))


def op6_swap_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each piece's place in a sequence."""
    docs = table(spark, sf_dir, "documents")
    return packing.pack_documents(docs, "doc_id", "text", public_tokenizers.path("byte_bpe_50k.json")).drop("ids")


def op7_pruned_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each vector's links and component within its label."""
    return graph_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


def op8_suffix_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's pieces, and whether they decode to it."""
    docs = table(spark, sf_dir, "documents")
    whole = suffix_pieces.encode_and_decode(docs, "doc_id", "text", public_tokenizers.path("piece_bpe_32k.model"))
    return whole.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_ids"), F.crc32("ids").alias("ids_crc32"),
                        F.length("decoded").cast("long").alias("n_chars"), "round_trip")


def op9_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each page's host, path, rule and verdict."""
    return url_rules.judge_urls(table(spark, sf_dir, "pages"))


def op10_token_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's place in the token files, read back from them."""
    docs = table(spark, sf_dir, "documents")
    return token_store.store_and_read(docs, "doc_id", "text", public_tokenizers.path("word_bpe_49k.json"))


def op11_hilbert_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every 50th vector, where every seventh has been given the next label."""
    rows = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.withColumn("label", moved))


def op12_jacobi_davidson(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first four whitened components of each vector."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_distinct_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's ids and what they decode to, as digests."""
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    coded = word_bpe.encode(table(spark, sf_dir, "documents"), "doc_id", "text", ranks)
    return word_bpe.decode(coded, "ids", ranks).select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                                                       F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of the corpus pipeline over the documents."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = [op1_shard_table, op2_secret_spans, op3_dart_minhash, op4_language_family, op5_rotated_codes, op6_swap_packing,
             op7_pruned_graph, op8_suffix_pieces, op9_url_rules, op10_token_frames,
             op11_hilbert_negatives, op12_jacobi_davidson, op13_distinct_words, pipeline]
    return {f.__name__: f for f in named}


#: Classes of op3: distinct runs of five words, all pairs that share one, links at 0.8, then the smallest id that links reach.
_OP3_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[a-z0-9\x{80}-\x{10FFFF}]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 5 THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))
                                          WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE c >= 0.8 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r(id, root) AS (SELECT doc_id, doc_id FROM documents UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.id)
SELECT id AS doc_id, min(root) AS class_id FROM r GROUP BY id
"""


_USABLE = "NOT list_contains(list_transform(v, lambda x: x IS NULL OR isnan(x) OR isinf(x)), true) AND list_dot_product(v, v) > 0"

_OP5_SQL = f"""
WITH e AS (SELECT vec_id, v FROM (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings) WHERE {_USABLE}),
p AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v) AS score FROM e q JOIN e c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p) WHERE rank <= 20
"""

_OP7_SQL = f"""
WITH RECURSIVE e AS (SELECT vec_id, label, v FROM (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings) WHERE label IS NOT NULL AND {_USABLE}),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM e a JOIN e b ON a.label = b.label AND a.vec_id <> b.vec_id
      WHERE list_dot_product(a.v, b.v) / sqrt(list_dot_product(a.v, a.v) * list_dot_product(b.v, b.v)) >= 0.93),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a),
r(id, root) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT l.b, r.root FROM r JOIN l ON l.a = r.id),
c AS (SELECT id, min(root) AS root FROM r GROUP BY id)
SELECT vec_id, coalesce(n, 0) AS n_links, root AS component_id, vec_id = root AS kept
FROM embeddings JOIN c ON c.id = vec_id LEFT JOIN n ON n.a = vec_id
"""


_OP11_SQL = """
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(v, lambda x: floor(256 * x)) AS v
           FROM (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL)
           WHERE NOT list_contains(list_transform(v, lambda x: x IS NULL OR isnan(x) OR isinf(x)), true)),
s AS (SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_dot_product(a.v, c.v)::BIGINT AS score
      FROM e a JOIN e c ON a.vec_id % 50 = 0 AND a.vec_id <> c.vec_id),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score
      FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS n FROM s WHERE same) WHERE n <= 5),
h AS (SELECT p.anchor_id, positive_id, s.vec_id AS negative_id, positive_score, s.score AS negative_score,
             row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS rank
      FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM h WHERE rank <= 3
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_shard_table": sharding.oracle_sql(), "op3_dart_minhash": _OP3_SQL, "op5_rotated_codes": _OP5_SQL,
            "op7_pruned_graph": _OP7_SQL, "op9_url_rules": url_rules.ORACLE_SQL, "op11_hilbert_negatives": _OP11_SQL}

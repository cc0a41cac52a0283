"""The registered queries of this subpackage: each operator over its whole table, in the form asked for."""

from __future__ import annotations

from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlake.llm import byte_bpe, divergence, language, lexical, line_crf, line_dedup, neighbours, order_minhash, packing, quality, secrets, sharding, toxicity
from bazaarlake.llm.common import fold, table

RANK_FILE = "byte_bpe_multi_50k.tiktoken"
WORD_TOKENIZER = "word_bpe_49k.json"
SHARDS = 24


def vocabulary(name: str) -> bytes:
    """A vocabulary file of the machine that the driver runs on; a few MB, sent to the executors."""
    return Path(public_tokenizers.path(name)).read_bytes()


def op1_markov_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.scanned(docs, secrets.fit(docs))
    of_kind = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long")
    return found.select(
        "doc_id", of_kind(0).alias("n_assign"), of_kind(1).alias("n_access"), of_kind(2).alias("n_hex"),
        F.sha2(secrets.as_text(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        secrets.as_text(F.col("spans")).alias("spans"))


def op2_adaptive_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.concat_ws(",", "broken").alias("broken"))


def op3_counterfactual_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels.where(fold("doc_id", 5) != 0))
    return toxicity.scored(docs.select("doc_id", "text"), model, "score").select(
        "doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op4_byte_network_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    network = language.fit(docs.where(fold("doc_id", 4) != 2))
    return language.identified(docs.select("doc_id", "text"), network).select(
        "doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


def op5_contiguous_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_contiguous(table(spark, sf_dir, "documents"), SHARDS).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks, pattern = vocabulary(RANK_FILE), public_tokenizers.PATTERN
    return byte_bpe.round_trip_documents(table(spark, sf_dir, "documents"), ranks, pattern).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op7_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary(WORD_TOKENIZER).decode())


def op8_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.classed(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "found_links")


def op9_hash_prefix_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op10_segment_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    lines = F.when(F.col("text").isNull(), 0).otherwise(F.size(F.split("text", "\n")))
    counted = docs.select("doc_id", line_dedup.text_key(F.col("text")).alias("text_key"), lines.alias("n_lines"))
    gone = line_dedup.removed_lines(docs)
    joined = counted.join(gone, counted["doc_id"].eqNullSafe(gone["id"]) & (counted["text_key"] == gone["key"]), "left")
    return joined.select(
        "doc_id", "n_lines", F.coalesce(F.size("removed"), F.lit(0)).alias("n_removed"),
        F.coalesce(F.array_join(F.col("removed").cast("array<string>"), ","), F.lit("")).alias("removed"))


def op11_line_crf_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    field = line_crf.fit(docs, labels.where(fold("doc_id", 5) != 0))
    return line_crf.scored(docs.select("doc_id", "text"), field, "score").select(
        "doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op12_nra_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), top=20)


def op13_packed_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.Audit(table(spark, sf_dir, "documents")).report()


QUERIES = {
    "op1_markov_secrets": op1_markov_secrets,
    "op2_adaptive_quality": op2_adaptive_quality,
    "op3_counterfactual_toxicity": op3_counterfactual_toxicity,
    "op4_byte_network_language": op4_byte_network_language,
    "op5_contiguous_shards": op5_contiguous_shards,
    "op6_byte_bpe": op6_byte_bpe,
    "op7_sum_of_squares_packing": op7_sum_of_squares_packing,
    "op8_order_minhash": op8_order_minhash,
    "op9_hash_prefix_forest": op9_hash_prefix_forest,
    "op10_segment_line_dedup": op10_segment_line_dedup,
    "op11_line_crf_quality": op11_line_crf_quality,
    "op12_nra_search": op12_nra_search,
    "op13_packed_divergence": op13_packed_divergence,
}

_SEARCH_SQL = r"""
    WITH docs AS (
      SELECT row_number() OVER () AS d, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
    corpus AS (SELECT count(*) AS n, sum(len(terms)) AS l FROM docs WHERE len(terms) > 0),
    sought AS (
      SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM (SELECT DISTINCT item_id, text FROM benchmark)),
    asked AS (SELECT item_id, term, count(*) AS repeats FROM sought GROUP BY ALL),
    postings AS (
      SELECT d, term, count(*) AS tf FROM (SELECT d, unnest(terms) AS term FROM docs) WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
    weights AS (
      SELECT term, floor(1000 * ln((2 * any_value(n) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM postings, corpus GROUP BY term),
    impacts AS (
      SELECT d, term, w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + ((25 * len(terms) * n) // l)::BIGINT))) AS impact
      FROM postings JOIN weights USING (term) JOIN docs USING (d), corpus),
    scores AS (SELECT item_id, d, sum(repeats * impact)::BIGINT AS score FROM asked JOIN impacts USING (term) GROUP BY ALL)
    SELECT item_id, rank::INT AS rank, doc_id, score
    FROM (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank
          FROM scores JOIN docs USING (d) WHERE score > 0)
    WHERE rank <= 20"""

_DIVERGENCE_SQL = r"""
    WITH docs AS (
      SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body FROM documents),
    words AS (SELECT d, lang, source, unnest(regexp_extract_all(body, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
    kept AS (SELECT lang, term, count(*) AS n FROM words GROUP BY ALL HAVING count(DISTINCT d) >= 10),
    seen AS (SELECT w.lang, source, term, count(*) AS n FROM words w JOIN kept USING (lang, term) GROUP BY ALL),
    vocabulary AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
    groups AS (
      SELECT g.lang, g.source, coalesce(v, 0)::HUGEINT AS v, coalesce(total, 0) AS lang_total, coalesce((SELECT sum(n) FROM seen s WHERE s.lang = g.lang AND s.source = g.source), 0) AS total
      FROM (SELECT DISTINCT lang, source FROM docs) g LEFT JOIN vocabulary USING (lang)),
    shares AS (
      SELECT g.lang, g.source, k.term, coalesce(s.n, 0) AS n, (1 + 1000000000::HUGEINT * (coalesce(s.n, 0) + 2) // (g.total + 2 * g.v))::BIGINT AS p,
             (1 + 1000000000::HUGEINT * (k.n + 2) // (g.lang_total + 2 * g.v))::BIGINT AS q
      FROM groups g JOIN kept k USING (lang) LEFT JOIN seen s USING (lang, source, term)),
    found AS (
      SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(sum(x.f), 0)::BIGINT AS value
      FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
      LEFT JOIN (SELECT s.lang, s.source, t.source AS item, ((s.p - t.p) * (s.p - t.p)) // (s.p + t.p) AS f
                 FROM shares s JOIN shares t ON s.lang = t.lang AND s.term = t.term AND s.source <> t.source) x
        ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
      GROUP BY ALL
      UNION ALL
      SELECT lang, source, 'term', term, ((p - q) * (p - q)) // (p + q) FROM shares WHERE n > 0 AND p > q)
    SELECT lang, source, part, item, value, rank::INT AS rank
    FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM found)
    WHERE part = 'pair' OR rank <= 10"""

ORACLE_SQL: dict[str, str] = {"op12_nra_search": _SEARCH_SQL, "op13_packed_divergence": _DIVERGENCE_SQL}

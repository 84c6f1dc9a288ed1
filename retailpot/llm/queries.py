"""One query per operator of this subpackage, with production parameters, over whole tables."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retailpot.llm import best_fit, fingerprints, html_text, ngram_join, packing, pii, quality_model, quality_rules, sentence_pieces, sharding, token_counts, vector_codes, whitening
from retailpot.llm.common import stored, table
from retailpot.llm.tokens import tokenizer_path
from retailpot.session import shared_root

TOKEN_LIMIT = 2048
N_SHARDS = 40
PREDICTED_FROM = 0.3


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.components(table(spark, sf_dir, "documents"), 4, ngram_join.Threshold(85, 100))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality_model.fit(*quality_model.labelled_sample(docs, table(spark, sf_dir, "labels")))
    scored = quality_model.score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", quality_model.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= PREDICTED_FROM).cast("int").alias("predicted"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    slim = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), sharding.digest(F.col("text")).alias("g"))
    placed = sharding.shard(stored(slim, "sizes"), N_SHARDS)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    docs = docs.withColumn("n_bytes", F.octet_length(F.coalesce("text", F.lit(""))).cast("long"))
    tokenizer = tokenizer_path("word_bpe_49k.json")
    cache = f"{shared_root(spark)}/llm/token_cache-{hashlib.sha256(f'{sf_dir}:{token_counts.tokenizer_digest(tokenizer)}'.encode()).hexdigest()[:24]}"
    counted = token_counts.count_tokens(docs, cache, tokenizer)
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rules = quality_rules.fit(*quality_model.labelled_sample(docs, table(spark, sf_dir, "labels")))
    return quality_rules.judge(docs.select("doc_id", "text"), rules).drop("text")


def op7_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = sentence_pieces.encoded(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))
    return coded.select("doc_id", "n_ids", "ids_crc32", F.length("decoded").cast("long").alias("decoded_chars"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"), "round_trip")


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint(table(spark, sf_dir, "documents"))


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find(docs, pii.fit(docs))
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [(F.size("base") - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{name}") for k, name in enumerate(pii.KINDS)]
    return found.select("doc_id", *counts, F.sha2(pii.spelled(F.col("base")).cast("binary"), 256).alias("base_sha256"), pii.spelled(F.col("spans")).alias("spans"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(table(spark, sf_dir, "embeddings"))[0]


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit.pack(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_join": op1_ngram_join,
    "op2_quality_classifier": op2_quality_classifier,
    "op3_sharding": op3_sharding,
    "op4_token_counts": op4_token_counts,
    "op5_packing": op5_packing,
    "op6_quality_rules": op6_quality_rules,
    "op7_sentence_pieces": op7_sentence_pieces,
    "op8_fingerprints": op8_fingerprints,
    "op9_html_extraction": op9_html_extraction,
    "op10_pii": op10_pii,
    "op11_vector_codes": op11_vector_codes,
    "op12_whitening": op12_whitening,
    "op13_best_fit_packing": op13_best_fit_packing,
}


def _vector_codes_sql() -> str:
    """Lloyd rounds written out: the same sums and floors with every entry compared."""
    parts, entries, scale, rounds = vector_codes.PARTS, vector_codes.ENTRIES, vector_codes.SCALE, vector_codes.ROUNDS
    steps = [f"""kept AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda c: CAST(floor(CAST(c AS DOUBLE) * {scale}) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NOT NULL AND isfinite(c))) = len(embedding))""",
             f"""x AS MATERIALIZED (SELECT vec_id, (i - 1) * {parts} // len(v) AS part, (i - 1) % (len(v) // {parts}) AS pos, v[i] AS x FROM (SELECT vec_id, v, unnest(range(1, len(v) + 1)) AS i FROM kept))""",
             f"""seeds AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept QUALIFY entry < {entries})""",
             "b0 AS MATERIALIZED (SELECT part, entry, pos, x AS c FROM x JOIN seeds USING (vec_id))"]
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (SELECT vec_id, part, arg_min(entry, d * 1000 + entry) AS entry, min(d) AS d FROM
  (SELECT vec_id, part, entry, CAST(sum((x - c) * (x - c)) AS BIGINT) AS d FROM x JOIN b{r} USING (part, pos) GROUP BY ALL) GROUP BY ALL)""")
        if r < rounds:
            steps.append(f"""b{r + 1} AS MATERIALIZED (SELECT part, entry, pos, coalesce(m, c) AS c FROM b{r} LEFT JOIN
  (SELECT part, entry, pos, (s - ((s % n) + n) % n) // n AS m FROM (SELECT part, entry, pos, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM x JOIN a{r} USING (vec_id, part) GROUP BY ALL)) USING (part, entry, pos))""")
    steps.append(f"""coded AS MATERIALIZED (SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{rounds} GROUP BY vec_id)""")
    return "WITH " + ",\n".join(steps) + f"""
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY part, entry, pos)) FROM b{rounds}) AS codebooks_sha256 FROM coded JOIN kept USING (vec_id)"""


ORACLES: dict[str, str] = {"op11_vector_codes": _vector_codes_sql()}

"""The registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medloom.llm import decontaminate, html, infill, langid, licenses, mixing, quality, sanitise, tokens, turns, warc
from medloom.llm.repeats import remove_repeats
from medloom.llm.simhash import near_duplicates


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.archive_and_index(_table(spark, sf_dir, "pages"))
    return found.select(
        "page_id", "payload_bytes", F.col("digest").alias("payload_digest"), "record_type", "refers_to")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.judge(_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), slop=decontaminate.SLOP)
    named = F.sort_array(F.transform("items", lambda i: i.cast("string")))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", named), 256).alias("items_sha256"), "contaminated",
        "n_near", F.size("near").cast("long").alias("n_near_places"))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html.extract(_table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(_table(spark, sf_dir, "documents"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(_table(spark, sf_dir, "documents"))
    held = F.transform("matches", lambda m: m["label"])
    best = F.array_max(F.transform("matches", lambda m: m["containment"]))
    return found.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", F.concat_ws(",", "base_labels").alias("base_labels"),
        F.concat_ws(",", F.sort_array(F.array_union("base_labels", held))).alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce(best, F.lit(0.0))).alias("score"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("simhash"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sanitise.sanitise(_table(spark, sf_dir, "documents"))
    counts = [sanitise.number_of(F.col("spans"), kind).alias(f"n_{kind}") for kind in sanitise.KINDS]
    base = F.sha2(sanitise.as_text(sanitise.base_only(F.col("spans"))), 256)
    return found.select("doc_id", *counts, base.alias("base_sha256"), sanitise.as_text(F.col("spans")).alias("spans"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = turns.repair(turns.damage(_table(spark, sf_dir, "conversations")))
    return found.withColumnRenamed("conv", "conv_id")


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.fit(docs))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = infill.transform(_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(infill.restored(), 256).alias("restored_sha256"))


_QUERIES = {f.__name__: f for f in (
    op1_warc_index, op2_quality_rules, op3_substring_dedup, op4_decontamination, op5_html_extraction, op6_mix_sources,
    op7_token_counts, op8_license_scan, op9_simhash, op10_pii, op11_conversation_repair, op12_language_id, op13_fill_in_middle)}
_SQL = {
    "op1_warc_index": warc.SQL,
    "op2_quality_rules": quality.SQL,
    "op4_decontamination": decontaminate.SQL,
    "op3_substring_dedup": """
WITH w AS (
  SELECT row_number() OVER () AS r, doc_id,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws
  FROM documents),
win AS (
  SELECT r, unnest(range(len(ws) - 34)) AS p, ws FROM w WHERE len(ws) >= 35),
keyed AS (SELECT r, p, array_to_string(ws[p + 1 : p + 35], ' ') AS k FROM win),
rep AS (SELECT r, p FROM (SELECT r, p, count(*) OVER (PARTITION BY k) AS c FROM keyed) WHERE c > 1),
cov AS (SELECT DISTINCT r, p + i AS q FROM rep, range(35) t(i)),
gone AS (SELECT r, list(q) AS qs, count(*) AS c FROM cov GROUP BY r),
flat AS (SELECT r, unnest(ws) AS x, unnest(range(len(ws))) AS q FROM w),
kept AS (
  SELECT flat.r, string_agg(x, ' ' ORDER BY flat.q) AS t FROM flat ANTI JOIN cov ON flat.r = cov.r AND flat.q = cov.q GROUP BY flat.r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(c, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN gone ON w.r = gone.r LEFT JOIN kept ON w.r = kept.r
""",
    "op6_mix_sources": mixing.SQL,
    "op8_license_scan": licenses.SQL,
    "op11_conversation_repair": turns.SQL,
    "op13_fill_in_middle": infill.SQL,
}


def queries() -> dict:
    import corpus_pipeline

    return _QUERIES | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)

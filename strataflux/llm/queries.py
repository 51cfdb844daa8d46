"""Queries that apply the operators to whole tables."""

from __future__ import annotations

import hashlib
import string
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from strataflux.llm import ann, bpe, html, langid, licenses, linededup, merkle, neardup, packing, prefixes, quality, substrings, warc
from strataflux.llm.common import materialise, remove, shared_dir
from strataflux.llm.oracles import OP4_SQL, OP9_SQL, OP10_SQL, OP11_SQL, OP12_SQL, OP13_SQL

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang").withColumn("held_out", F.crc32(F.col("doc_id").cast("string")) % 3 == 1)
    model = langid.fit(docs, ~F.col("held_out"))
    return langid.identify(docs.select("doc_id", "text", "held_out"), model).select("doc_id", "held_out", "lang_pred", "score", "lang_shares")


def op2_quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality.features(_table(spark, sf_dir, "documents").select("doc_id", "text")).withColumn("base_failed", quality.base_failed())
    # Every count is asked for, so that the cascade finds its order but has no feature left to save.
    rules = [quality.Rule("base", quality.base_failed(), ("n_words", "n_repeat_words")), *quality.default_rules()]
    return quality.cascade(rows, rules, given=quality.FEATURES).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", F.col("passed").alias("kept"))


def vocabulary(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(_table(spark, sf_dir, "pages"))


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(_table(spark, sf_dir, "documents"), size=3, percent=85)


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    def digest(ids, text):
        return len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(text).hexdigest()

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.encode(docs, vocabulary("byte_bpe_50k.json"), digest, "n_tokens long, ids_sha256 string, decoded_sha256 string")


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack(packing.pieces(docs, vocabulary("word_bpe_49k.json")))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    def digest(text, words, gone):
        return len(words), int(gone.sum()), hashlib.sha256(b" ".join(w for w, g in zip(words, gone.tolist()) if not g)).hexdigest()

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    out = substrings.apply(docs, substrings.repeats(docs), digest, "n_words long, n_removed long, kept_sha256 string")
    return out.select("doc_id", "result.*")


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return linededup.apply(docs, linededup.repeated_lines(docs)).select("doc_id", "n_lines", "n_removed_lines", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark)
    with warc.pushdown(spark):
        out = materialise(warc.round_trip(_table(spark, sf_dir, "pages").select("page_id", "url", "html"), path))
    remove(spark, path)
    return out


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixes.prefix_trie(_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"), heads=True)


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fifth document or so is tampered with: its capitals A-Z are lowered."""
    docs = _table(spark, sf_dir, "documents").select(*merkle.FIELDS)
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    given = merkle.digest([lowered if c == "text" else F.col(c) for c in merkle.FIELDS])
    return merkle.manifest(docs, F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, given))


OP2_SQL = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), p AS (
  SELECT doc_id, i, w[i:i + 4] AS win FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d)
), r AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS n FROM p) WHERE n > 1
), c AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM r, range(0, 5) AS s(k) GROUP BY doc_id
), l AS (
  SELECT doc_id, count(*) - count(DISTINCT x) AS n FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS x FROM d)
  WHERE regexp_matches(x, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id
), f AS (
  SELECT d.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    coalesce(l.n, 0)::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN c USING (doc_id) LEFT JOIN l USING (doc_id)
)
SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words OR n_symbols * 10 > n_words * 3 OR n_dup_lines * 100 > n_words * 5
    OR word_chars < n_words * 2 OR word_chars > n_words * 15) AS kept
FROM f
"""


def queries() -> dict[str, Query]:
    return {k: v for k, v in globals().items() if k.startswith("op") and callable(v)}


def oracle_sql() -> dict[str, str]:
    return {"op2_quality_cascade": OP2_SQL, "op4_near_duplicates": OP4_SQL, "op9_substring_dedup": OP9_SQL, "op10_line_dedup": OP10_SQL, "op11_warc": OP11_SQL, "op12_prefix_trie": OP12_SQL, "op13_merkle_manifest": OP13_SQL}

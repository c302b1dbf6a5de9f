"""The numbered queries of this subpackage, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op3_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tickloom.llm.embeddings import near_vectors

    return near_vectors(_read(spark, sf_dir, "embeddings"))


def op9_chat_prefix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tickloom.llm.chat import format_chats, read_back, with_tricky
    from tickloom.llm.common import stage

    packed = stage(format_chats(with_tricky(_read(spark, sf_dir, "conversations"))), "chats")
    return read_back(packed)


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tickloom.llm.simhash import hex_of, near_duplicates

    out = near_duplicates(_read(spark, sf_dir, "documents"))
    return out.select("doc_id", hex_of(F.col("fp")).alias("fingerprint"), "component_id")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tickloom.llm.packing import pack

    return pack(_read(spark, sf_dir, "documents"))


def op2_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tickloom.llm.pii import replace_pii, session_key

    return replace_pii(_read(spark, sf_dir, "documents"), session_key(spark)).select("doc_id", "text", "n_entities")


def op4_ngram_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tickloom.llm.ngrams import score

    return score(_read(spark, sf_dir, "documents"))


def op5_weighted_fair_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tickloom.llm.mixing import schedule

    plan = schedule(_read(spark, sf_dir, "documents"))
    return plan.select(F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("size") * F.col("passes")).alias("taken"), "source", "finish")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tickloom.llm.language import identify

    return identify(_read(spark, sf_dir, "documents"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tickloom.llm.quality import judge

    return judge(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tickloom.llm.common import remainder
    from tickloom.llm.toxicity import toxicity

    scored = toxicity(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))
    held_out = F.coalesce(remainder("doc_id", 3) == 1, F.lit(False)).alias("held_out")
    return scored.select("doc_id", held_out, "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op11_nb_svm_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tickloom.llm.nb_svm import classify

    return classify(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tickloom.llm.fim import fill_in_middle, restored

    made = fill_in_middle(_read(spark, sf_dir, "documents"))
    sha = lambda text: F.sha2(text.cast("binary"), 256)
    out, form = F.col("fim.text"), F.col("fim.form")
    return made.select("doc_id", "fim.n", "fim.form", "fim.prefix_chars", "fim.middle_chars", sha(out).alias("output_sha256"), sha(restored(out, form)).alias("restored_sha256"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tickloom.llm.resample import resample

    return resample(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_pii_surrogates": op2_pii_surrogates,
    "op3_embedding_near_dedup": op3_embedding_near_dedup,
    "op4_ngram_scoring": op4_ngram_scoring,
    "op5_weighted_fair_mixing": op5_weighted_fair_mixing,
    "op6_language_id": op6_language_id,
    "op7_quality_rules": op7_quality_rules,
    "op8_toxicity": op8_toxicity,
    "op9_chat_prefix_tree": op9_chat_prefix_tree,
    "op10_simhash_near_dedup": op10_simhash_near_dedup,
    "op11_nb_svm_quality": op11_nb_svm_quality,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_importance_resampling": op13_importance_resampling,
}

#: op12 in SQL: the tokens as a list, cut at the drawn numbers.
FILL_IN_MIDDLE = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || doc_id) AS hx, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS tok FROM documents),
e AS (SELECT doc_id, t, tok, len(tok) AS n, ('0x' || hx[1:8])::UBIGINT AS h1, ('0x' || hx[9:16])::UBIGINT AS h2, ('0x' || hx[17:24])::UBIGINT AS h3, ('0x' || hx[25:32])::UBIGINT AS h4 FROM d),
f AS (SELECT doc_id, t, tok, n, least(h1 % (n + 1), h2 % (n + 1))::BIGINT AS a, greatest(h1 % (n + 1), h2 % (n + 1))::BIGINT AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM e),
g AS (SELECT doc_id, t, n, form, array_to_string(tok[1:a], '') AS p, array_to_string(tok[a + 1:b], '') AS m, array_to_string(tok[b + 1:], '') AS s FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
    sha256(CASE form WHEN 'plain' THEN t ELSE p || m || s END) AS restored_sha256 FROM g"""

ORACLES: dict[str, str] = {"op12_fill_in_middle": FILL_IN_MIDDLE}

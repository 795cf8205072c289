"""The registered queries of the corpus operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    collocations,
    exact_dedup,
    hmm,
    html_mincut,
    licence_scan,
    mixing,
    quality_crf,
    sentencepiece_fst,
    simhash_pivot,
    toxicity,
    vector_codes,
    warc_zstd,
    winnow,
)
from tidemark.llm.common import table, whole

Query = Callable[[SparkSession, str], DataFrame]


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.decide(table(spark, sf_dir, "documents"))


def op2_winnow(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = winnow.edited(table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id",
        F.length("text").cast("bigint").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        winnow.digest(F.col("picks")).alias("fingerprint"),
        winnow.digest(F.col("edited_picks")).alias("edited_fingerprint"),
        winnow.likeness(F.col("hashes"), winnow.hashes(F.col("edited_picks"))).alias("near_edited"),
        winnow.likeness(F.col("hashes"), F.col("next_hashes")).alias("near_next"),
    )


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    machine = sentencepiece_fst.compile_model()
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = sentencepiece_fst.encode(docs, machine, proof=True)
    return rows.select(
        "doc_id",
        F.length(whole(F.col("text"))).cast("bigint").alias("n_chars"),
        F.size("ids").cast("bigint").alias("n_tokens"),
        "ids",
        "decoded_sha256",
        "round_trip",
    )


def op4_hmm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.score(table(spark, sf_dir, "documents"))


def op5_simhash_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_pivot.near(table(spark, sf_dir, "documents"))


def op6_html_mincut(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    rows = html_mincut.extract(pages, html_mincut.train(pages))
    return rows.withColumn("n_chars", F.length("text").cast("bigint"))


def op7_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = licence_scan.licences(table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id",
        F.array_join("matches.licence", ", ").alias("licences"),
        F.size("matches").cast("bigint").alias("n_matches"),
        F.array_join(F.transform("matches", lambda m: F.concat_ws("-", m["start"], m["end"])), ", ").alias("spans"),
    )


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op9_quality_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    learn = "crc32(cast(cast(id AS string) AS binary)) % 5 != 0"
    return quality_crf.score(docs, quality_crf.train(docs, table(spark, sf_dir, "labels"), where=learn))


def op10_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken")
    )


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = collocations.best(collocations.phrases(table(spark, sf_dir, "documents")))
    return found.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op12_warc_zstd(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    kind = pages.schema["page_id"].dataType
    rows = warc_zstd.resolved(warc_zstd.write(pages).read())
    return rows.withColumns({c: F.col(c).cast(kind) for c in ("page_id", "refers_to")})


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.report(table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Query]:
    named = (
        op1_exact_dedup, op2_winnow, op3_sentencepiece, op4_hmm_score, op5_simhash_pivot, op6_html_mincut,
        op7_licence_scan, op8_toxicity, op9_quality_crf, op10_source_mix, op11_collocations, op12_warc_zstd,
        op13_vector_codes,
    )
    return {q.__name__: q for q in named}

"""The operators applied to whole tables, by name, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from railpulse.llm import (
    arc, decontaminate, embeddings, html_text, language, lexical, ngram_join, packing, pii, repeats, spelling, token_files,
    toxicity,
)
from railpulse.llm import oracle as sql
from railpulse.llm.common import documents
from railpulse.session import prepare


def tokenizer_path() -> str:
    """Where the public vocabulary lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path(packing.TOKENIZER)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(documents(spark, sf_dir))


def op3_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.language_id(documents(spark, sf_dir))


def op5_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(documents(spark, sf_dir)).drop("kept")


def op6_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir), tokenizer_path())


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_digest(documents(spark, sf_dir))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return arc.archived(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_contained(
        documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    )


def op11_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.rank_documents(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_digest(documents(spark, sf_dir), tokenizer_path())


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(documents(spark, sf_dir))


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [
        op1_toxicity, op2_ngram_join, op3_html, op4_language, op5_repeats, op6_embeddings, op7_packing, op8_pii, op9_warc,
        op10_decontamination, op11_lexical, op12_token_files, op13_spelling,
    ]

    def pinned(work):
        return lambda spark, sf_dir: work(prepare(spark), sf_dir)

    return {work.__name__: pinned(work) for work in found}


def oracle() -> dict[str, str]:
    return sql.oracle()

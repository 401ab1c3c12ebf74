"""The registered queries of this package and their DuckDB SQL, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from propyield.llm import sql
from propyield.llm.ann import neighbours_report
from propyield.llm.bpe import bpe_report, read_ranks
from propyield.llm.hard_negatives import mining_report
from propyield.llm.hmm import hmm_scores
from propyield.llm.jaccard import ngram_components
from propyield.llm.langid import identify
from propyield.llm.mixing import mix_report
from propyield.llm.pii import pii_report
from propyield.llm.quality import quality_report
from propyield.llm.secret_scan import secret_report
from propyield.llm.spelling import spelling_variants
from propyield.llm.token_files import token_files_report
from propyield.llm.toxicity import fit, score_toxicity
from propyield.session import scratch_path

QueryFn = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def over_documents(report: Callable[[DataFrame], DataFrame]) -> QueryFn:
    return lambda spark, sf_dir: report(table(spark, sf_dir, "documents"))


def bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return bpe_report(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_toxicity(docs, fit(docs, table(spark, sf_dir, "labels")))


def token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        vocabulary = f.read()
    return token_files_report(table(spark, sf_dir, "documents"), vocabulary, scratch_path(spark, "token-files"))


QUERIES: dict[str, QueryFn] = {
    "op1_bpe": bpe,
    "op2_hmm": over_documents(hmm_scores),
    "op3_neighbours": lambda spark, sf_dir: neighbours_report(table(spark, sf_dir, "embeddings")),
    "op4_jaccard": over_documents(ngram_components),
    "op5_pii": over_documents(pii_report),
    "op6_language": lambda spark, sf_dir: identify(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents")),
    "op7_quality": over_documents(quality_report),
    "op8_secrets": over_documents(secret_report),
    "op9_mixing": over_documents(mix_report),
    "op10_toxicity": toxicity,
    "op11_spelling": over_documents(spelling_variants),
    "op12_hard_negatives": lambda spark, sf_dir: mining_report(table(spark, sf_dir, "embeddings")),
    "op13_token_files": token_files,
}

SQL: dict[str, str] = {"op4_jaccard": sql.JACCARD, "op7_quality": sql.QUALITY, "op11_spelling": sql.SPELLING,
                       "op12_hard_negatives": sql.MINING}

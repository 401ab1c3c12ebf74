"""A training-data pipeline over ``documents``: toxic texts out, one document of each group
of near copies, personal data masked, sources mixed to target weights, texts encoded.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns
a DataFrame. ``run`` writes each stage's result as Parquet below the shared folder and
reads it again for the next one, so a lost executor repeats one stage at most. All but
the last stage return the columns of ``documents``.

No SQL can express the fitted classifier or the encoding, so ``ORACLE_SQL`` is None;
the tests hold the stages against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from propyield.llm.bpe import encode, read_ranks
from propyield.llm.jaccard import one_of_each
from propyield.llm.mixing import mixed_documents
from propyield.llm.pii import mask_pii
from propyield.llm.toxicity import fit, without_toxic
from propyield.session import scratch_path

#: The vocabulary of the last stage, one of the public rank files.
VOCABULARY = "byte_bpe_multi_50k.tiktoken"

ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal regression does not call toxic."""
    return without_toxic(docs, fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of the n-gram Jaccard join."""
    return one_of_each(docs)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind, ``n_chars`` that of the new text."""
    masked = mask_pii(docs)
    if "n_chars" not in docs.columns:
        return masked
    kind = docs.schema["n_chars"].dataType
    length = F.when(F.col("text").isNotNull(), F.length("text").cast(kind)).otherwise(F.col("n_chars"))
    return masked.withColumn("n_chars", length)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: each document as often as its source's target takes it, in training order."""
    return mixed_documents(docs)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids (packed little-endian uint32) and their round trip."""
    import public_tokenizers

    ranks = read_ranks(public_tokenizers.path(VOCABULARY))
    coded = encode(docs, ranks, public_tokenizers.PATTERN, decoded=True)
    return coded.select("doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"), "ids",
                        F.sha2("decoded", 256).alias("decoded_sha256"),
                        (F.sha2("decoded", 256) == F.col("text_sha256")).alias("round_trip"))


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_copies),
    ("pii", mask_personal_data),
    ("mixing", mix_sources),
    ("byte_level_bpe", encode_texts),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

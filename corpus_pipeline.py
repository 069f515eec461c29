"""The corpus pipeline: quality, near duplicates, secrets, mixing, tokens.

Each stage reads what its predecessor kept, as Parquet, and all but the last return the columns of ``documents``, with any further
columns, whatever their names. The stages' tables stay in the shared folder until its application's folder is deleted.

Defined cases, for all stages: an empty table gives an empty one; a row with a null text or source, or a null or repeated id, is a row like
others; long texts are taken whole.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm import jaccard, mixing, pieces, quality, secrets
from strandline.llm.shared import cut, free, table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the classifier rejects: null and empty texts too, once it has labels of both classes to learn from."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of each group of near duplicates the document with the least id (null last; of equal ids one); texts without words all stay."""
    return jaccard.keep_one_of_each(docs)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Puts the kind of each secret in its place, and renews ``n_chars``; drops no document; a null text stays null."""
    redacted = secrets.redact_secrets(docs)
    return redacted.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else redacted


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats documents by their source's rate, 0 times or more (a null source is one of its own), in a shuffled order."""
    copy, shuffle_key = free(docs, "copy", "shuffle_key")
    return mixing.mix_sources(docs, copy=copy, shuffle_key=shuffle_key).drop(copy, shuffle_key)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds the column ``pieces``, the ids of a sampled segmentation (in place of one of that name); none for null and empty texts."""
    return pieces.encode_documents(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("quality classifier", quality_classifier),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("secret scans", secret_scans),
    ("mixing sources to target weights", mixing_sources),
    ("SentencePiece encoding and decoding", sentencepiece),
]

#: The stages hold a trained model, components of a graph and sampled pieces, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

"""Corpus pipeline: five stages over `documents`, each written and read again before the next.

Documents without a recognised language go; of each group of near-duplicates one stays; contaminated documents go;
secrets are replaced in the texts; what is left is encoded.  Every stage works on all that the one before it kept.

Defined results: texts that are NULL or have no letter go in the first stage; other columns, and further ones
of any name, are kept up to the last stage; repeated rows are near-duplicates of each other; an empty table stays
empty.  `lang` is learned from where it is present, never trusted for a document itself.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pricewright.llm.common import documents, importable_in_workers, stored
from pricewright.llm.decontamination import clean_documents
from pricewright.llm.language_id import known_languages
from pricewright.llm.secret_scan import redact_documents
from pricewright.llm.sentencepiece_codec import encode_documents
from pricewright.llm.simhash import keep_one_of_each

# Why there is no SQL: fingerprints, profiles, decoding layers and the tokenizer cannot be stated in it.
ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return known_languages(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return redact_documents(docs, length="n_chars" if "n_chars" in docs.columns else None)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return encode_documents(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("language_id", language),
    ("simhash_near_dedup", near_duplicates),
    ("decontamination", decontamination),
    ("secret_scan", secrets),
    ("sentencepiece", encoding),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    importable_in_workers(spark)
    docs = documents(spark, sf_dir)
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs

"""From raw documents to token ids: language, boilerplate lines, near duplicates, mix of sources, BPE.

Each stage takes the documents that the one before has left, and is written as a table and read again. All but the last
return the columns of documents; n_chars follows the text.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barmill.llm import language, mixing, shingle_join, site_lines, transducer
from barmill.llm.util import documents, stored

#: Shingles of five words, and the similarity in percent from which documents are near duplicates.
SHINGLE, PERCENT = 5, 80


def by_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a language can be told; a null or empty text, or one without a letter, goes.

    So does a text too far from every profile, by bounds set on held-out documents: one of a language that was not
    learned, or noise. Profiles are learned from the labelled documents that are not held out. If nothing is learned
    from them, all that have letters stay. The label column stays as it is.
    """
    profiles = language.taught(docs)
    if profiles.langs:
        said = language.identify(docs, profiles, bounds=language.bounds(docs, profiles))
        kept = said.where(F.col("lang_pred") != language.UNKNOWN)
    else:
        kept = docs.where(F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    return kept.select(*docs.columns)


def without_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that many documents of their source have, and long ones that unrelated documents share.

    No document goes.
    """
    clean = site_lines.drop_boilerplate(site_lines.drop_passages(docs), F.col("source"))
    return clean.select(*(F.length("text").cast("long").alias(c) if c == "n_chars" else F.col(c) for c in docs.columns))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the least id; documents without words all stay."""
    return shingle_join.first_of_each(docs, k=SHINGLE, percent=PERCENT)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them, so that rows may repeat."""
    return mixing.mixed(docs)


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, ids, and whether decoding gives the text back."""
    return transducer.tokenised(docs, public_tokenizers.path("byte_bpe_50k.json")).select(
        "doc_id", "lang", "source", "n_tokens", "ids", "lossless"
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language id", by_language),
    ("line dedup", without_boilerplate),
    ("near duplicates", one_of_each_group),
    ("source mix", mixed_sources),
    ("bpe", to_tokens),
]

#: Token ids and language profiles are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)

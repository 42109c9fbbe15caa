"""Corpus pipeline: five stages over ``documents``.

Each stage takes ``(spark, docs, sf_dir)``, works on all that the one before
kept, and returns documents; its result is written as Parquet in the shared
folder and read again.  The last stage returns the mix.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kardex.llm import decontaminate, langid, mixing, pii, simhash
from kardex.llm.common import read, shared_dir
from kardex.llm.queries import PII_KEY


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told stay: a text without letters, or
    with no language at half the posterior or more, goes.

    Null and empty texts go; equal rows share their fate; a null id is no
    reason to go; columns of any other name pass; an empty table stays empty.
    """
    model = langid.fit(docs)
    told = langid.identify(docs, model, pred_col="__lang", score_col="__score")
    return told.where(langid.accepted("__lang", "__score")).drop("__lang", "__score")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each SimHash group stays.

    Null and empty texts are a group; of rows equal in the id one stays, null
    ids come last; columns of any other name pass; an empty table stays empty.
    """
    return simhash.one_of_each_group(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go; the others lose the words of benchmark
    phrases they hold.

    Null texts stay null and empty ones empty; equal rows stay equal; null
    items hold no phrase; columns of any other name pass; an empty table stays
    empty, an empty benchmark changes nothing.
    """
    return decontaminate.clean(docs, read(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal values get format-preserving pseudonyms.

    Null texts stay null; equal texts stay equal; ids are not read; columns of
    any other name pass; an empty table stays empty.
    """
    return pii.pseudonymise(docs, PII_KEY, count_col=None)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: per document ``doc_id, text, source, size, source_size, target,
    taken`` (words the mix takes of it, repeats counted).

    Null texts have no words and are taken nothing of; null is a source of its
    own; equal rows are rows of their own; an empty table gives no rows.
    """
    return mixing.mixed_texts(docs).withColumnRenamed("id", "doc_id")


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("mixture", mixture),
]

#: Language scores are sums over segmentations, which SQL cannot express; the
#: pipeline is tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4()}"
    docs = read(spark, sf_dir, "documents")
    for place, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{place}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

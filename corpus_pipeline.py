"""The corpus pipeline: quality, near duplicates, contamination, mix, token files."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tasteloom.llm import decontaminate, jaccard, mixing, quality, tokenfiles
from tasteloom.llm.base import saved, scratch
from tasteloom.llm.queries import table, tokenizer_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The documents that the quality rules keep."""
    return quality.kept(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of texts with five-word shingles and similarity 0.8."""
    return jaccard.one_of_each(docs, n=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The documents without benchmark passages."""
    return decontaminate.clean(docs, table(spark, folder, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixing.mixed(docs)


def token_files(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The documents as token files, and what is read back from these."""
    return tokenfiles.read(spark, tokenfiles.write(docs, tokenizer_path()))


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("source mix", source_mix),
    ("token files", token_files),
]


def run(spark: SparkSession, folder: str) -> DataFrame:
    """Apply all stages to ``documents``; each is written and read again by the next."""
    docs = table(spark, folder, "documents")
    base = f"{scratch(spark, 'pipeline')}-{uuid.uuid4().hex[:6]}"
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, folder)
        if i < len(STAGES) - 1:
            docs = saved(docs, f"{base}/{i}")
    return docs


#: The tokens of the last stage and the join of near texts are not expressed in SQL.
ORACLE_SQL = None

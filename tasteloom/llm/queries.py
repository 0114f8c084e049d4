"""The operators as queries over the given tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tasteloom.llm import (
    decontaminate,
    html,
    jaccard,
    licenses,
    linededup,
    merkle,
    mixing,
    neardup,
    quality,
    substrings,
    tokenfiles,
    trie,
    warc,
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    index = linededup.LineIndex.empty(spark).insert(docs)
    return linededup.digest(index.screen(docs))


def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.report(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op3_token_files(spark: SparkSession, folder: str) -> DataFrame:
    files = tokenfiles.write(table(spark, folder, "documents"), tokenizer_path())
    return tokenfiles.read(spark, files)


def op4_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.assessed(table(spark, folder, "documents")).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


def op5_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(table(spark, folder, "documents"))


def op6_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    found = mixing.plan(table(spark, folder, "documents"))
    return found.select("doc_id", "size", "source_size", "target", "taken")


def op7_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    found = jaccard.groups(table(spark, folder, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


def op8_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.digest(substrings.deduplicated(table(spark, folder, "documents")))


def op9_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return html.extract(table(spark, folder, "pages"))


def op10_warc(spark: SparkSession, folder: str) -> DataFrame:
    files = warc.write(table(spark, folder, "pages"))
    return warc.read(spark, files).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op11_embedding_neardup(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, folder, "embeddings"))


def op12_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.build(table(spark, folder, "documents"), merkle.without_breaks()).report()


def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations")
    return trie.trie(trie.rebuilt(trie.sequences(turns)))


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [
        op1_line_dedup,
        op2_decontamination,
        op3_token_files,
        op4_quality_rules,
        op5_license_scan,
        op6_source_mix,
        op7_jaccard_join,
        op8_substring_dedup,
        op9_main_text,
        op10_warc,
        op11_embedding_neardup,
        op12_merkle_manifest,
        op13_prefix_trie,
        pipeline,
    ]
    return {query.__name__: query for query in found}



"""Queries of the training-data operators, with production parameters, over
their whole tables; and DuckDB SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from tracelake.llm import (
    decontam,
    licenses,
    linededup,
    neardup,
    packing,
    quality,
    repeats,
    secrets,
    sharding,
    toxicity,
    trie,
    whitening,
    wordpieces,
)
from tracelake.llm.common import table


def op1_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    """Counterfactual-regularised classifier: a score for every document."""
    docs = table(spark, sf, "documents")
    model = toxicity.fit(docs, table(spark, sf, "labels"), use=lambda i: ~toxicity.held_out(i))
    found = toxicity.score(docs, model)
    return found.select("doc_id", toxicity.held_out(found["doc_id"]).alias("held_out"), "score", "predicted")


def op2_sharding(spark: SparkSession, sf: str) -> DataFrame:
    """Shard and slot of every document, by sampled splitters."""
    return sharding.digest(sharding.shard(table(spark, sf, "documents")))


def op3_licenses(spark: SparkSession, sf: str) -> DataFrame:
    """Licence families named in every document, confirmed by template."""
    docs = table(spark, sf, "documents")
    return licenses.digest(licenses.scan(docs, licenses.fit(docs)))


def op4_secrets(spark: SparkSession, sf: str) -> DataFrame:
    """Secret spans of every document, confirmed by structure."""
    return secrets.digest(secrets.scan(table(spark, sf, "documents")))


def op5_linededup(spark: SparkSession, sf: str) -> DataFrame:
    """Lines of every document that an earlier line is alike."""
    return linededup.dropped_lines(table(spark, sf, "documents"))


def op6_repeats(spark: SparkSession, sf: str) -> DataFrame:
    """What is left of every document without repeated 200-byte strings."""
    return repeats.digest(*repeats.remove_repeats(table(spark, sf, "documents")))


def op7_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    """Words of every document that lie in a window of a benchmark item."""
    return decontam.digest(decontam.scan(table(spark, sf, "documents"), table(spark, sf, "benchmark")))


def op8_neardup(spark: SparkSession, sf: str) -> DataFrame:
    """Near-duplicate class of every document."""
    return neardup.near_duplicates(table(spark, sf, "documents"))


def op9_packing(spark: SparkSession, sf: str) -> DataFrame:
    """All documents' pieces, packed shortest pack first."""
    return packing.pack(packing.pieces(table(spark, sf, "documents")))


def op10_quality(spark: SparkSession, sf: str) -> DataFrame:
    """Base rules and the line field's verdict for every document."""
    docs = table(spark, sf, "documents")
    found = quality.judge(docs, quality.fit(docs, table(spark, sf, "labels")))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "content_share"
    )


def op11_whitening(spark: SparkSession, sf: str) -> DataFrame:
    """Embeddings projected on their 32 leading components, whitened."""
    vectors = table(spark, sf, "embeddings")
    model = whitening.fit(vectors)
    whitened = whitening.whiten(vectors, model)
    return whitening.digest(whitened, model, whitening.identity_error(whitened, model))


def op12_prefix_trie(spark: SparkSession, sf: str) -> DataFrame:
    """Every node of the prefix trie of the rebuilt conversations."""
    return trie.build(table(spark, sf, "conversations"))


def op13_sentencepiece(spark: SparkSession, sf: str) -> DataFrame:
    """Ids of every whole text, and what they decode to."""
    return wordpieces.digest(wordpieces.decode(wordpieces.encode(table(spark, sf, "documents"))))


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_toxicity": op1_toxicity,
        "op2_sharding": op2_sharding,
        "op3_licenses": op3_licenses,
        "op4_secrets": op4_secrets,
        "op5_linededup": op5_linededup,
        "op6_repeats": op6_repeats,
        "op7_decontamination": op7_decontamination,
        "op8_neardup": op8_neardup,
        "op9_packing": op9_packing,
        "op10_quality": op10_quality,
        "op11_whitening": op11_whitening,
        "op12_prefix_trie": op12_prefix_trie,
        "op13_sentencepiece": op13_sentencepiece,
        "pipeline": corpus_pipeline.run,
    }


def oracle() -> dict[str, str]:
    return {}

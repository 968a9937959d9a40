"""The queries of the numbered operators, one each, on their whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from orderloom.llm import decontamination, embedding_join, hidden_markov, html_text, ngram_join, packing, pii, prefix_trie, quality, sharding, suffix_dedup, topk_search, whitening
from orderloom.llm._shared import table

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    return {
        "op1_ngram_join": lambda s, d: ngram_join.join(table(s, d, "documents"), percent=90, n=3),
        "op2_packing": lambda s, d: packing.pack(table(s, d, "documents")),
        "op3_sharding": lambda s, d: sharding.shard(table(s, d, "documents")),
        "op4_hidden_markov": lambda s, d: hidden_markov.score(table(s, d, "documents")),
        "op5_suffix_dedup": lambda s, d: suffix_dedup.dedup(table(s, d, "documents")),
        "op6_quality": lambda s, d: quality.classify(table(s, d, "documents"), table(s, d, "labels")),
        "op7_pii": lambda s, d: pii.find(table(s, d, "documents")),
        "op8_html_text": lambda s, d: html_text.extract(table(s, d, "pages")),
        "op10_embedding_join": lambda s, d: embedding_join.join(table(s, d, "embeddings")),
        "op11_prefix_trie": lambda s, d: prefix_trie.trie(table(s, d, "conversations")),
        "op12_whitening": lambda s, d: whitening.whiten(table(s, d, "embeddings")),
        "op13_topk_search": lambda s, d: _searched(table(s, d, "embeddings")),
        "pipeline": corpus_pipeline.run,
        "op9_decontamination": lambda s, d: decontamination.contained_items(
            table(s, d, "documents"), table(s, d, "benchmark")
        ),
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op9_decontamination": decontamination.ORACLE_SQL,
        "op11_prefix_trie": prefix_trie.ORACLE_SQL,
        "op13_topk_search": topk_search.ORACLE_SQL,
    }


def _searched(vectors: DataFrame) -> DataFrame:
    return topk_search.search(vectors, vectors.filter("vec_id % 50 = 0"))

"""The registered queries of this subpackage, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (
    centroids,
    decontaminate,
    gru,
    html,
    language,
    packing,
    permutation,
    prefix_trie,
    sharding,
    simhash,
    surrogates,
    tokencounts,
    warc,
)
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_surrogates": lambda s, d: surrogates.report(table(s, d, "documents")),
    "op2_shuffle_shards": lambda s, d: sharding.document_shards(table(s, d, "documents")),
    "op3_decontamination": lambda s, d: decontaminate.report(
        table(s, d, "documents"), table(s, d, "benchmark")
    ),
    "op4_simhash": lambda s, d: simhash.document_components(table(s, d, "documents")),
    "op5_best_fit_packing": lambda s, d: packing.pack_documents(table(s, d, "documents")),
    "op6_language": lambda s, d: language.identify(table(s, d, "documents")),
    "op7_gru_scores": lambda s, d: gru.scores(table(s, d, "documents")),
    "op8_text_density": lambda s, d: html.extract(table(s, d, "pages")),
    "op9_seekable_warc": lambda s, d: warc.page_archive(table(s, d, "pages")),
    "op10_permutation_index": lambda s, d: permutation.neighbours(table(s, d, "embeddings")),
    "op11_prefix_trie": lambda s, d: prefix_trie.prefix_trie(table(s, d, "conversations")),
    "op12_pretoken_counts": lambda s, d: tokencounts.count_tokens(table(s, d, "documents")),
    "op13_ns_bounds": lambda s, d: centroids.report(table(s, d, "embeddings")),
}

SQL: dict[str, str] = {"op3_decontamination": decontaminate.ORACLE}

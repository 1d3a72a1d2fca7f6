"""The operators' queries by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shelfledger.llm import (byte_bpe, collocations, conversation_trie, decontamination, extraction, fingerprints, languages, near_duplicates, packing,
                             sharding, substrings, token_counts, toxicity)
from shelfledger.llm.common import configured


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {
        "op1_minhash_fingerprints": fingerprints.query,
        "op2_extract_pages": extraction.query,
        "op3_hilbert_shards": sharding.query,
        "op4_language_mixture": languages.query,
        "op5_token_counts": token_counts.query,
        "op6_toxic_spans": toxicity.query,
        "op7_benchmark_templates": decontamination.query,
        "op8_near_duplicates": near_duplicates.query,
        "op9_repeated_substrings": substrings.query,
        "op10_pack_sequences": packing.query,
        "op11_byte_bpe": byte_bpe.query,
        "op12_conversation_trie": conversation_trie.query,
        "op13_collocations": collocations.query,
    }
    return {name: configured(query) for name, query in found.items()}


def oracle_sql() -> dict[str, str]:
    return {"op9_repeated_substrings": substrings.SQL, "op12_conversation_trie": conversation_trie.SQL,
            "op13_collocations": collocations.SQL}

"""The registered queries of this subpackage and their check SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from ledgertide.llm import (decontaminate, jaccard_join, language, mixing, prefix_trie, quality_rules,
                            sharding, site_style, substring_dedup, suffix_array, token_alignment, token_counts, warc)


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_warc": warc.op1_warc,
        "op2_language": language.op2_language,
        "op3_shard": sharding.op3_shard,
        "op4_jaccard_join": jaccard_join.op4_jaccard_join,
        "op5_main_text": site_style.op5_main_text,
        "op6_mix": mixing.op6_mix,
        "op7_substring_dedup": substring_dedup.op7_substring_dedup,
        "op8_quality_rules": quality_rules.op8_quality_rules,
        "op9_token_counts": token_counts.op9_token_counts,
        "op10_decontaminate": decontaminate.op10_decontaminate,
        "op11_prefix_trie": prefix_trie.op11_prefix_trie,
        "op12_token_alignment": token_alignment.op12_token_alignment,
        "op13_suffix_array": suffix_array.op13_suffix_array,
        "pipeline": corpus_pipeline.run,
    }


def check_sql() -> dict[str, str]:
    sql = {
        "op1_warc": warc.OP1_SQL,
        "op4_jaccard_join": jaccard_join.OP4_SQL,
        "op6_mix": mixing.OP6_SQL,
        "op7_substring_dedup": substring_dedup.OP7_SQL,
        "op10_decontaminate": decontaminate.OP10_SQL,
        "op11_prefix_trie": prefix_trie.OP11_SQL,
        "op13_suffix_array": suffix_array.OP13_SQL,
        "pipeline": corpus_pipeline.ORACLE_SQL,
    }
    return {name: text for name, text in sql.items() if text}

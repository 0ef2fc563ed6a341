"""The registered training-data queries and the SQL they must agree with."""

from __future__ import annotations

import corpus_pipeline
from logloom.llm import (
    block_search, hard_negatives, importance, merkle, mixing, packing, pstable, quality_rules, sharding, simhash, sql, token_files, tool_calls, wrappers,
)

QUERIES = {
    "pipeline": corpus_pipeline.run,
    "op1_sharding": sharding.op1_sharding,
    "op2_simhash": simhash.op2_simhash,
    "op3_html_extraction": wrappers.op3_html_extraction,
    "op4_embedding_links": pstable.op4_embedding_links,
    "op5_packing": packing.op5_packing,
    "op6_tool_calls": tool_calls.op6_tool_calls,
    "op7_quality_rules": quality_rules.op7_quality_rules,
    "op8_importance": importance.op8_importance,
    "op9_token_files": token_files.op9_token_files,
    "op10_mixing": mixing.op10_mixing,
    "op11_merkle": merkle.op11_merkle,
    "op12_hard_negatives": hard_negatives.op12_hard_negatives,
    "op13_block_search": block_search.op13_block_search,
}


def queries():
    return dict(QUERIES)


def oracle_sql():
    return {name: text for name, text in sql.ORACLE.items() if name in QUERIES}

"""The queries of this folder and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tenure.llm import byte_bpe, chat, exact_dedup, html_text, merkle, minhash, negatives, neighbours, packing, pii, simhash, toxicity, url_rules

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    return {
        "op1_exact_dedup": exact_dedup.op1_exact_dedup,
        "op2_simhash": simhash.op2_simhash,
        "op3_chat": chat.op3_chat,
        "op4_neighbours": neighbours.op4_neighbours,
        "op5_html_text": html_text.op5_html_text,
        "op6_toxicity": toxicity.op6_toxicity,
        "op7_byte_bpe": byte_bpe.op7_byte_bpe,
        "op8_packing": packing.op8_packing,
        "op9_pii": pii.op9_pii,
        "op10_url_rules": url_rules.op10_url_rules,
        "op11_merkle": merkle.op11_merkle,
        "op12_hard_negatives": negatives.op12_hard_negatives,
        "op13_minhash": minhash.op13_minhash,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_exact_dedup": exact_dedup.OP1_SQL, "op3_chat": chat.OP3_SQL,
        "op11_merkle": merkle.OP11_SQL, "op12_hard_negatives": negatives.OP12_SQL,
    }

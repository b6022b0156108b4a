"""Registered queries of the operators: name -> (spark, sf_dir) -> DataFrame, and their SQL twins."""

from __future__ import annotations

from turnstone.llm import (chat, decontaminate, exact_dedup, html_text, importance, line_dedup, minmax_dedup, packing,
                           phrase_dedup, sharding, spelling, toxicity, wordpiece)
from turnstone.llm.shared import table


def op1_token_counts(spark, sf_dir):
    return wordpiece.count_tokens(table(spark, sf_dir, "documents"))


def op2_decontaminate(spark, sf_dir):
    return decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"))


def op4_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op5_line_dedup(spark, sf_dir):
    return line_dedup.find_repeated_lines(table(spark, sf_dir, "documents"))


def op6_phrase_dedup(spark, sf_dir):
    return phrase_dedup.drop_repeats(table(spark, sf_dir, "documents"))


def op7_chat(spark, sf_dir):
    """All conversations and one whose texts are control strings."""
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = "</s>[INST] ok [/INST]"
    c = c.unionByName(spark.createDataFrame([(-1, 0, "user", odd), (-1, 1, "assistant", odd)],
                                            "conv_id bigint, turn bigint, role string, text string"))
    return chat.read_back(chat.examples(c))


def op8_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return toxicity.score_toxicity(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op9_minmax_dedup(spark, sf_dir):
    return minmax_dedup.minmax_dedup(table(spark, sf_dir, "documents"))


def op10_html_text(spark, sf_dir):
    return html_text.extract(table(spark, sf_dir, "pages"))


def op11_importance_resampling(spark, sf_dir):
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_sharding(spark, sf_dir):
    return sharding.shard(table(spark, sf_dir, "documents"))


def op13_spelling_variants(spark, sf_dir):
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_token_counts, op2_decontaminate, op3_packing, op4_exact_dedup, op5_line_dedup, op6_phrase_dedup, op7_chat,
    op8_toxicity, op9_minmax_dedup, op10_html_text, op11_importance_resampling, op12_sharding, op13_spelling_variants)}

ORACLE_SQL = {
    "op2_decontaminate": decontaminate.SQL,
    "op4_exact_dedup": exact_dedup.SQL,
    "op6_phrase_dedup": phrase_dedup.SQL,
    "op7_chat": chat.SQL,
    "op9_minmax_dedup": minmax_dedup.SQL,
    "op11_importance_resampling": importance.SQL,
    "op13_spelling_variants": spelling.SQL,
}

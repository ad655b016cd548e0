"""Queries of the training-data operators and their SQL."""

from . import chat, jaccard, langid, mixing, ordinal, packing, pii, quality_rules, topk, toxicity

QUERIES = {
    "op1_chat_formatting": chat.op1_chat_formatting,
    "op2_language_id": langid.op2_language_id,
    "op3_packing": packing.op3_packing,
    "op4_quality_rules": quality_rules.op4_quality_rules,
    "op5_toxicity": toxicity.op5_toxicity,
    "op6_exact_topk": topk.op6_exact_topk,
    "op7_mixing": mixing.op7_mixing,
    "op8_jaccard_join": jaccard.op8_jaccard_join,
    "op9_pii": pii.op9_pii,
    "op10_quality_classifier": ordinal.op10_quality_classifier,
}

SQL = {
    "op1_chat_formatting": chat.OP1_SQL,
    "op4_quality_rules": quality_rules.OP4_SQL,
    "op6_exact_topk": topk.OP6_SQL,
    "op7_mixing": mixing.OP7_SQL,
    "op8_jaccard_join": jaccard.OP8_SQL,
}

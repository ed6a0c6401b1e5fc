"""The registered corpus queries and their SQL, where SQL can express them."""

from __future__ import annotations

from . import chat, decontam, divergence, importance, jaccard, langid, media, mixing, pieces, quality, sharding, spans, urlrules
from .oracles import OP2_SQL, OP6_SQL, OP10_SQL

QUERIES = {
    "op1_interleaved_shards": sharding.op1_interleaved_shards,
    "op2_url_rules": urlrules.op2_url_rules,
    "op3_bloom_language": langid.op3_bloom_language,
    "op4_latent_leaks": decontam.op4_latent_leaks,
    "op5_png_media": media.op5_png_media,
    "op6_bayes_jaccard": jaccard.op6_bayes_jaccard,
    "op7_sentence_spans": spans.op7_sentence_spans,
    "op8_kernel_quality": quality.op8_kernel_quality,
    "op9_reply_chat": chat.op9_reply_chat,
    "op10_source_mixture": mixing.op10_source_mixture,
    "op11_importance_ring": importance.op11_importance_ring,
    "op12_prefix_pieces": pieces.op12_prefix_pieces,
    "op13_source_divergence": divergence.op13_source_divergence,
    "mixture_taken": mixing.mixture_taken,
}

ORACLE_SQL = {"op2_url_rules": OP2_SQL, "op6_bayes_jaccard": OP6_SQL, "op9_reply_chat": chat.OP9_SQL, "op13_source_divergence": divergence.OP13_SQL, "mixture_taken": OP10_SQL}

"""The operators as registered queries, over the whole of their tables, and their SQL."""

from __future__ import annotations

from paxledger.llm import archive, chat, decontam, negatives, neardup, packing, quality, ratios, runs, secrets, shards, spots, suffixes
from paxledger.llm.common import table

QUERIES = {
    "op1_lyndon_suffix_dedup": lambda spark, d: suffixes.op1_lyndon_suffix_dedup(spark, table(spark, d, "documents")),
    "op2_compression_quality": quality.op2_compression_quality,
    "op3_latent_leaks": decontam.op3_latent_leaks,
    "op4_multi_index_hamming": lambda spark, d: neardup.op4_multi_index_hamming(spark, table(spark, d, "documents")),
    "op5_secret_ledger": lambda spark, d: secrets.op5_secret_ledger(spark, table(spark, d, "documents")),
    "op6_merkle_audit": lambda spark, d: archive.op6_merkle_audit(spark, table(spark, d, "pages")),
    "op7_hypergeometric_shards": lambda spark, d: shards.op7_hypergeometric_shards(spark, table(spark, d, "documents")),
    "op8_shortest_pack_first": lambda spark, d: packing.op8_shortest_pack_first(spark, table(spark, d, "documents")),
    "op9_spotsigs": lambda spark, d: spots.op9_spotsigs(spark, table(spark, d, "documents")),
    "op10_event_sourced_chat": lambda spark, d: chat.op10_event_sourced_chat(spark, table(spark, d, "conversations")),
    "op11_scale_tiled_runs": runs.op11_scale_tiled_runs,
    "op12_ngram_ratio": ratios.op12_ngram_ratio,
    "op13_lemp_negatives": negatives.op13_lemp_negatives,
}
SQL = {
    "op1_lyndon_suffix_dedup": suffixes.OP1_SQL,
    "op4_multi_index_hamming": neardup.OP4_SQL,
    "op5_secret_ledger": secrets.OP5_SQL,
    "op6_merkle_audit": archive.OP6_SQL,
    "op10_event_sourced_chat": chat.OP10_SQL,
    "op12_ngram_ratio": ratios.OP12_SQL,
    "op13_lemp_negatives": negatives.OP13_SQL,
}

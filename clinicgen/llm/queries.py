"""The registered queries of this package and their SQL."""

from __future__ import annotations

from clinicgen.llm import align, ann, chat, decontam, filter_audit, hpylm, mix, quality, shard, simhash, substrings, token_files, warc

QUERIES = {
    "op1_spaced_seed_overlaps": decontam.op1_spaced_seed_overlaps,
    "op2_hypergeometric_shards": shard.op2_hypergeometric_shards,
    "op3_warc_zst": warc.op3_warc_zst,
    "op4_mix_sources": mix.op4_mix_sources,
    "op5_pitman_yor_scores": hpylm.op5_pitman_yor_scores,
    "op6_quality_scores": quality.op6_quality_scores,
    "op7_simhash_components": simhash.op7_simhash_components,
    "op8_prefix_targets": chat.op8_prefix_targets,
    "op9_kmeans_tree_search": ann.op9_kmeans_tree_search,
    "op10_arrow_token_files": token_files.op10_arrow_token_files,
    "op11_token_alignment": align.op11_token_alignment,
    "op12_substring_dedup": substrings.op12_substring_dedup,
    "op13_filter_interactions": filter_audit.op13_filter_interactions,
}

ORACLE_SQL = {
    "op3_warc_zst": warc.OP3_SQL,
    "op4_mix_sources": mix.OP4_SQL,
    "op8_prefix_targets": chat.OP8_SQL,
    "op13_filter_interactions": filter_audit.OP13_SQL,
}

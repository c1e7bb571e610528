"""The operators' queries over the given tables, and SQL for those that SQL can express."""

from . import fingerprint, html, jaccard, langid, lm, mixing, packing, quality, repair, rules, tokencount, trie, warc

QUERIES = {
    "op1_language_id": langid.op1_language_id,
    "op2_lm_scoring": lm.op2_lm_scoring,
    "op3_jaccard_join": jaccard.op3_jaccard_join,
    "op4_fingerprints": fingerprint.op4_fingerprints,
    "op5_mixing": mixing.op5_mixing,
    "op6_html_extraction": html.op6_html_extraction,
    "op7_token_counts": tokencount.op7_token_counts,
    "op8_packing": packing.op8_packing,
    "op9_quality": quality.op9_quality,
    "op10_quality_rules": rules.op10_quality_rules,
    "op11_warc": warc.op11_warc,
    "op12_prefix_trie": trie.op12_prefix_trie,
    "op13_structure_repair": repair.op13_structure_repair,
}

ORACLE = {
    "op3_jaccard_join": jaccard.ORACLE_OP3,
    "op5_mixing": mixing.ORACLE_OP5,
    "op11_warc": warc.ORACLE_OP11,
    "op12_prefix_trie": trie.ORACLE_OP12,
}

"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from triagelake.llm import (
    classifier, fingerprints, html_text, lm_scores, mixing, ngram_join, packing, prefix_trie, ranked_search, rules,
    token_files, url_filter, warc_files,
)

QUERIES = {
    "op1_url_filter": url_filter.op1_url_filter,
    "op2_quality_classifier": classifier.op2_quality_classifier,
    "op3_main_text": html_text.op3_main_text,
    "op4_token_files": token_files.op4_token_files,
    "op5_fingerprints": fingerprints.op5_fingerprints,
    "op6_quality_rules": rules.op6_quality_rules,
    "op7_ngram_join": ngram_join.op7_ngram_join,
    "op8_packing": packing.op8_packing,
    "op9_lm_scores": lm_scores.op9_lm_scores,
    "op10_mixing": mixing.op10_mixing,
    "op11_prefix_trie": prefix_trie.op11_prefix_trie,
    "op12_ranked_search": ranked_search.op12_ranked_search,
    "op13_warc_files": warc_files.op13_warc_files,
}

ORACLES = {
    "op1_url_filter": url_filter.OP1_SQL,
    "op6_quality_rules": rules.OP6_SQL,
    "op10_mixing": mixing.OP10_SQL,
    "op11_prefix_trie": prefix_trie.OP11_SQL,
    "op12_ranked_search": ranked_search.OP12_SQL,
    "op13_warc_files": warc_files.OP13_SQL,
}

"""The queries of the corpus operators and, where SQL can say the same, their SQL."""

from __future__ import annotations

from . import alignment, language_id, lexical, licences, mixing, neardup, packing, quality, secrets, token_counts, token_store, topk, warc

QUERIES = {
    "op1_quality_rules": quality.query,
    "op2_language_id": language_id.query,
    "op3_best_fit_packing": packing.query,
    "op4_token_store": token_store.query,
    "op5_licence_scan": licences.query,
    "op6_token_counts": token_counts.query,
    "op7_minhash_near_dedup": neardup.query,
    "op8_secret_scan": secrets.query,
    "op9_source_mixing": mixing.query,
    "op10_exact_top_k": topk.query,
    "op11_warc": warc.query,
    "op12_ranked_lexical_search": lexical.query,
    "op13_cross_tokenizer_alignment": alignment.query,
}
SQL = {
    "op1_quality_rules": quality.SQL,
    "op9_source_mixing": mixing.SQL,
    "op10_exact_top_k": topk.SQL,
    "op11_warc": warc.SQL,
    "op12_ranked_lexical_search": lexical.SQL,
}

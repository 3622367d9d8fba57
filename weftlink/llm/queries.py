"""The queries of this subpackage and their SQL, by name."""

from __future__ import annotations

from . import decontaminate, exact_dedup, html_extract, lang_id, line_dedup, ngram_join, packing, sharding, token_codec, url_filters

QUERIES = {
    "op1_lang_id": lang_id.op1_lang_id,
    "op2_kd_sharding": sharding.op2_kd_sharding,
    "op3_best_fit_packing": packing.op3_best_fit_packing,
    "op4_ngram_join": ngram_join.op4_ngram_join,
    "op5_url_filters": url_filters.op5_url_filters,
    "op6_exact_dedup": exact_dedup.op6_exact_dedup,
    "op7_html_extract": html_extract.op7_html_extract,
    "op8_token_codec": token_codec.op8_token_codec,
    "op9_decontaminate": decontaminate.op9_decontaminate,
    "op10_line_dedup": line_dedup.op10_line_dedup,
}

ORACLES = {
    "op5_url_filters": url_filters.ORACLE,
    "op6_exact_dedup": exact_dedup.ORACLE,
}

"""The named queries of this subpackage, and DuckDB SQL where SQL can say it."""

from __future__ import annotations

from seriesforge.llm import chat, decontaminate, lexical, merkle, near_dup, url_filter, warc
from seriesforge.llm.chat import op4_chat_formatting
from seriesforge.llm.decontaminate import op3_benchmark_decontamination
from seriesforge.llm.langid import op12_language_id
from seriesforge.llm.lexical import op13_ranked_lexical_search
from seriesforge.llm.merkle import op11_merkle_manifest
from seriesforge.llm.near_dup import op5_minhash_near_dup
from seriesforge.llm.packing import op9_best_fit_packing
from seriesforge.llm.paragraphs import op2_paragraph_dedup
from seriesforge.llm.pii import op10_weak_supervision_pii
from seriesforge.llm.quality import op1_quality_rules
from seriesforge.llm.suffix_dedup import op8_suffix_dedup
from seriesforge.llm.url_filter import op6_url_filters
from seriesforge.llm.warc import op7_warc_bundles

QUERIES = {
    f.__name__: f
    for f in (op1_quality_rules, op2_paragraph_dedup, op3_benchmark_decontamination, op4_chat_formatting, op5_minhash_near_dup,
              op6_url_filters, op7_warc_bundles, op8_suffix_dedup, op9_best_fit_packing, op10_weak_supervision_pii, op11_merkle_manifest,
              op12_language_id, op13_ranked_lexical_search)
}

#: The others train a model, hash, sort or tokenise in ways SQL cannot say; their
#: tests compare them with brute force.
ORACLE = {
    "op3_benchmark_decontamination": decontaminate.ORACLE_SQL,
    "op4_chat_formatting": chat.ORACLE_SQL,
    "op5_minhash_near_dup": near_dup.ORACLE_SQL,
    "op6_url_filters": url_filter.ORACLE_SQL,
    "op7_warc_bundles": warc.ORACLE_SQL,
    "op11_merkle_manifest": merkle.ORACLE_SQL,
    "op13_ranked_lexical_search": lexical.ORACLE_SQL,
}

"""Registered queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

import corpus_pipeline
from pitwall.llm import (decontaminate, fim, jaccard, katz, language_id, licenses, mixing, quality, radix,
                         records, secrets, sharding, toxicity)

QUERIES = {
    "op1_mix_sources": mixing.op1_mix_sources,
    "op2_language_id": language_id.op2_language_id,
    "op3_shard_slots": sharding.op3_shard_slots,
    "op4_decontaminate": decontaminate.op4_decontaminate,
    "op5_toxicity_ftrl": toxicity.op5_toxicity_ftrl,
    "op6_katz_backoff": katz.op6_katz_backoff,
    "op7_quality_divergence": quality.op7_quality_divergence,
    "op8_license_scan": licenses.op8_license_scan,
    "op9_jaccard_join": jaccard.op9_jaccard_join,
    "op10_secret_scan": secrets.op10_secret_scan,
    "op11_fill_in_middle": fim.op11_fill_in_middle,
    "op12_conversation_trie": radix.op12_conversation_trie,
    "op13_token_records": records.op13_token_records,
    "pipeline": corpus_pipeline.run,
}

ORACLE_SQL = {
    "op1_mix_sources": mixing.OP1_SQL,
    "op7_quality_divergence": quality.OP7_SQL,
    "op8_license_scan": licenses.OP8_SQL,
    "op9_jaccard_join": jaccard.OP9_SQL,
    "op11_fill_in_middle": fim.OP11_SQL,
    "op12_conversation_trie": radix.OP12_SQL,
}

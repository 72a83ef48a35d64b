"""Corpus queries by name, with their SQL where there is one."""

from __future__ import annotations

from pitlane.llm import oracles
from pitlane.llm.alignment import op13_token_alignment
from pitlane.llm.conversations import op11_conversation_repair
from pitlane.llm.decontaminate import op7_decontamination
from pitlane.llm.gam_quality import op6_quality_gam
from pitlane.llm.jaccard_join import op3_jaccard_join
from pitlane.llm.langid import op9_language_id
from pitlane.llm.licenses import op8_license_digests
from pitlane.llm.packing import op4_best_fit_packing
from pitlane.llm.pii import op5_pii_deobfuscation
from pitlane.llm.quality_rules import op1_quality_rules
from pitlane.llm.secrets import op10_secret_scan
from pitlane.llm.sharding import op12_byte_shards
from pitlane.llm.toxicity import op2_toxicity

QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_toxicity": op2_toxicity,
    "op3_jaccard_join": op3_jaccard_join,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_pii_deobfuscation": op5_pii_deobfuscation,
    "op6_quality_gam": op6_quality_gam,
    "op7_decontamination": op7_decontamination,
    "op8_license_digests": op8_license_digests,
    "op9_language_id": op9_language_id,
    "op10_secret_scan": op10_secret_scan,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_byte_shards": op12_byte_shards,
    "op13_token_alignment": op13_token_alignment,
}

ORACLES = {
    "op1_quality_rules": oracles.OP1,
    "op8_license_digests": oracles.OP8,
    "op11_conversation_repair": oracles.OP11,
    "op12_byte_shards": oracles.OP12,
}

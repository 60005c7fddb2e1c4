"""Registered queries of this package, and the SQL that checks those which SQL can express."""

from __future__ import annotations

from geoledger.llm.chunks import op10_chunk_reuse_bpe
from geoledger.llm.jaccard import op9_size_aware_jaccard
from geoledger.llm.lines import ORACLE as LINES_ORACLE
from geoledger.llm.lines import op6_winnowed_line_dedup
from geoledger.llm.merkle import op8_merkle_fingerprints
from geoledger.llm.middle import ORACLE as MIDDLE_ORACLE
from geoledger.llm.middle import op11_learned_rank_middle
from geoledger.llm.packing import op2_hierarchical_packing
from geoledger.llm.pii import op4_bootstrapped_pii
from geoledger.llm.prefixes import op13_prefix_token_counts
from geoledger.llm.quality import op1_weak_supervision
from geoledger.llm.repair import ORACLE as REPAIR_ORACLE
from geoledger.llm.repair import op12_survivor_viterbi_repair
from geoledger.llm.secrets import op7_randomness_battery
from geoledger.llm.sharding import op3_rendezvous_sharding
from geoledger.llm.simple8b import op5_simple8b_ids

QUERIES = {
    f.__name__: f
    for f in (
        op1_weak_supervision,
        op2_hierarchical_packing,
        op3_rendezvous_sharding,
        op4_bootstrapped_pii,
        op5_simple8b_ids,
        op6_winnowed_line_dedup,
        op7_randomness_battery,
        op8_merkle_fingerprints,
        op9_size_aware_jaccard,
        op10_chunk_reuse_bpe,
        op11_learned_rank_middle,
        op12_survivor_viterbi_repair,
        op13_prefix_token_counts,
    )
}

CHECKS: dict[str, str] = {
    "op6_winnowed_line_dedup": LINES_ORACLE,
    "op11_learned_rank_middle": MIDDLE_ORACLE,
    "op12_survivor_viterbi_repair": REPAIR_ORACLE,
}

"""Registered queries of this subpackage, and SQL for those that SQL can answer."""

from __future__ import annotations

from funnelmart.llm.chat import OP1_SQL, op1_reply_tree_chat
from funnelmart.llm.conversation_repair import OP11_SQL, op11_conversation_repair
from funnelmart.llm.decontamination import op3_spaced_seed_decontamination
from funnelmart.llm.mixing import op2_entropy_mixing
from funnelmart.llm.near_dedup import op9_icws_near_dedup
from funnelmart.llm.personal_data import op10_weak_supervision_pii
from funnelmart.llm.quality import op6_bradley_terry_quality
from funnelmart.llm.sharding import op4_hypergeometric_sharding
from funnelmart.llm.sliced_index import OP12_SQL, op12_bit_sliced_top_k
from funnelmart.llm.token_alignment import op13_merge_path_alignment
from funnelmart.llm.toxicity import op8_segment_toxicity
from funnelmart.llm.vector_dedup import op5_pruned_graph_dedup
from funnelmart.llm.warc import op7_warc_index_merge

QUERIES = {
    query.__name__: query
    for query in (
        op1_reply_tree_chat,
        op2_entropy_mixing,
        op3_spaced_seed_decontamination,
        op4_hypergeometric_sharding,
        op5_pruned_graph_dedup,
        op6_bradley_terry_quality,
        op7_warc_index_merge,
        op8_segment_toxicity,
        op9_icws_near_dedup,
        op10_weak_supervision_pii,
        op11_conversation_repair,
        op12_bit_sliced_top_k,
        op13_merge_path_alignment,
    )
}
SQL: dict[str, str] = {
    "op1_reply_tree_chat": OP1_SQL,
    "op11_conversation_repair": OP11_SQL,
    "op12_bit_sliced_top_k": OP12_SQL,
}

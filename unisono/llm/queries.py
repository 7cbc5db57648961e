"""Registered queries of this subpackage and the SQL that checks them."""

from __future__ import annotations

from . import ball_kmeans, conversation_repair, line_dedup, topk_search
from .ball_kmeans import op13_ball_kmeans
from .conversation_repair import op11_conversation_repair
from .decontamination import op1_decontamination
from .hilbert_sharding import op3_hilbert_sharding
from .html_extraction import op10_html_extraction
from .jaccard_join import op8_jaccard_join
from .language_id import op2_language_id
from .line_dedup import op6_line_dedup
from .packing import op5_packing
from .simhash_dedup import op12_simhash_dedup
from .suffix_dedup import op4_suffix_dedup
from .topk_search import op7_topk_search
from .toxicity import op9_toxicity

QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_language_id": op2_language_id,
    "op3_hilbert_sharding": op3_hilbert_sharding,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_packing": op5_packing,
    "op6_line_dedup": op6_line_dedup,
    "op7_topk_search": op7_topk_search,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_toxicity": op9_toxicity,
    "op10_html_extraction": op10_html_extraction,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_simhash_dedup": op12_simhash_dedup,
    "op13_ball_kmeans": op13_ball_kmeans,
}

ORACLE_SQL: dict[str, str] = {
    "op6_line_dedup": line_dedup.ORACLE_SQL,
    "op7_topk_search": topk_search.ORACLE_SQL,
    "op11_conversation_repair": conversation_repair.ORACLE_SQL,
    "op13_ball_kmeans": ball_kmeans.ORACLE_SQL,
}

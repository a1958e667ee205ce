"""Registered queries of this subpackage and the SQL that checks them."""

from __future__ import annotations

from dqspark.llm.centroids import OP13_SQL, op13_rotated_centroids
from dqspark.llm.chat import OP10_SQL, op10_chat_events
from dqspark.llm.cuckoo import OP11_SQL, op11_cuckoo_dedup
from dqspark.llm.decontamination import op3_simhash_windows
from dqspark.llm.hostrank import op9_host_pagerank
from dqspark.llm.licenses import op5_license_rules
from dqspark.llm.outliers import op2_robust_outliers
from dqspark.llm.packing import op1_vector_packing
from dqspark.llm.paragraphs import op8_paragraph_minhash
from dqspark.llm.ranked import OP12_SQL, op12_ranked_search
from dqspark.llm.simhash import op7_simhash_pivots
from dqspark.llm.toxicity import op4_toxicity_trees
from dqspark.llm.suffixes import OP6_SQL, op6_prefix_free_parsing

QUERIES = {
    f.__name__: f
    for f in (
        op1_vector_packing, op2_robust_outliers, op3_simhash_windows, op4_toxicity_trees, op5_license_rules,
        op6_prefix_free_parsing, op7_simhash_pivots, op8_paragraph_minhash, op9_host_pagerank, op10_chat_events,
        op11_cuckoo_dedup, op12_ranked_search, op13_rotated_centroids,
    )
}
ORACLES = {
    "op6_prefix_free_parsing": OP6_SQL,
    "op10_chat_events": OP10_SQL,
    "op11_cuckoo_dedup": OP11_SQL,
    "op12_ranked_search": OP12_SQL,
    "op13_rotated_centroids": OP13_SQL,
}

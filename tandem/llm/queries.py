"""Registered queries of this subpackage and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from tandem.llm import metric_tree, risk_rules, spelling, walsh_codes
from tandem.llm.ans import op1_ans_token_files
from tandem.llm.dropout import op9_merge_dropout
from tandem.llm.graph_search import op3_pruned_graph_search
from tandem.llm.importance import op5_importance_resampling
from tandem.llm.metric_tree import op12_metric_tree_top
from tandem.llm.overlap_join import op4_divide_skip_join
from tandem.llm.packing import op7_mixture_packing
from tandem.llm.pii import op6_weak_supervision_pii
from tandem.llm.prefix_counts import op10_prefix_token_counts
from tandem.llm.risk_rules import op8_risk_controlled_rules
from tandem.llm.run_index import op2_run_length_repeats
from tandem.llm.spelling import op13_composed_spelling_variants
from tandem.llm.walsh_codes import op11_walsh_hadamard_codes

QUERIES = {f.__name__: f for f in (
    op1_ans_token_files,
    op2_run_length_repeats,
    op3_pruned_graph_search,
    op4_divide_skip_join,
    op5_importance_resampling,
    op6_weak_supervision_pii,
    op7_mixture_packing,
    op8_risk_controlled_rules,
    op9_merge_dropout,
    op10_prefix_token_counts,
    op11_walsh_hadamard_codes,
    op12_metric_tree_top,
    op13_composed_spelling_variants,
)}

SQL: dict[str, str] = {
    "op8_risk_controlled_rules": risk_rules.SQL,
    "op11_walsh_hadamard_codes": walsh_codes.SQL,
    "op12_metric_tree_top": metric_tree.SQL,
    "op13_composed_spelling_variants": spelling.SQL,
}

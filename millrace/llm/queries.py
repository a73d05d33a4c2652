"""The opN queries and their SQL, where SQL can express them."""

from __future__ import annotations

from millrace.llm.line_dedup import op5_line_dedup
from millrace.llm.metric_topk import OP2_SQL, op2_metric_topk
from millrace.llm.mixing import op1_mixing
from millrace.llm.near_dedup import op3_near_dedup
from millrace.llm.packing import op9_packing
from millrace.llm.quality_rules import op6_quality_rules
from millrace.llm.token_counts import op10_token_counts
from millrace.llm.token_output import op4_token_output
from millrace.llm.toxicity import op8_toxicity
from millrace.llm.url_filter import OP7_SQL, op7_url_filter

QUERIES = {
    "op1_mixing": op1_mixing,
    "op5_line_dedup": op5_line_dedup,
    "op3_near_dedup": op3_near_dedup,
    "op2_metric_topk": op2_metric_topk,
    "op4_token_output": op4_token_output,
    "op6_quality_rules": op6_quality_rules,
    "op7_url_filter": op7_url_filter,
    "op8_toxicity": op8_toxicity,
    "op9_packing": op9_packing,
    "op10_token_counts": op10_token_counts,
}

ORACLE = {"op2_metric_topk": OP2_SQL, "op7_url_filter": OP7_SQL}

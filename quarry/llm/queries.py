"""The registered queries of this package, and the SQL of those that have one."""

from __future__ import annotations

from quarry.llm.conversations import op13_conversation_repair
from quarry.llm.fill_in_middle import OP12_SQL, op12_fill_in_middle
from quarry.llm.fingerprints import op7_fingerprints
from quarry.llm.language_model import op8_language_model
from quarry.llm.licenses import OP11_SQL, op11_license_scans
from quarry.llm.line_dedup import OP3_SQL, op3_line_dedup
from quarry.llm.mixing import op10_mixing
from quarry.llm.near_dedup import op2_near_dedup
from quarry.llm.packing import op1_best_fit_packing
from quarry.llm.quality_model import op5_quality_model
from quarry.llm.quality_rules import op4_quality_rules
from quarry.llm.token_counts import op9_token_counts
from quarry.llm.toxicity import op6_toxicity

QUERIES = {f.__name__: f for f in (op1_best_fit_packing, op2_near_dedup, op3_line_dedup, op4_quality_rules, op5_quality_model,
                                   op6_toxicity, op7_fingerprints, op8_language_model, op9_token_counts, op10_mixing,
                                   op11_license_scans, op12_fill_in_middle, op13_conversation_repair)}
ORACLE = {"op3_line_dedup": OP3_SQL.strip(), "op11_license_scans": OP11_SQL.strip(), "op12_fill_in_middle": OP12_SQL.strip()}

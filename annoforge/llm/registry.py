"""Queries of the text operators, and SQL for those that SQL can express."""

from __future__ import annotations

from annoforge.llm.byte_bpe import op9_byte_bpe
from annoforge.llm.conversations import OP11_SQL, op11_conversation_repair
from annoforge.llm.embedding_dup import OP6_SQL, op6_embedding_dup
from annoforge.llm.language import op8_language
from annoforge.llm.licenses import OP13_SQL, op13_licenses
from annoforge.llm.line_dedup import op5_line_dedup
from annoforge.llm.mixing import OP4_SQL, op4_mixing
from annoforge.llm.near_dup import OP2_SQL, op2_near_dup
from annoforge.llm.pii import op7_pii
from annoforge.llm.quality import op10_quality
from annoforge.llm.runs import op12_periodic_runs
from annoforge.llm.token_counts import op1_token_counts
from annoforge.llm.toxicity import op3_toxicity

QUERIES = {
    "op1_token_counts": op1_token_counts,
    "op2_near_dup": op2_near_dup,
    "op3_toxicity": op3_toxicity,
    "op4_mixing": op4_mixing,
    "op5_line_dedup": op5_line_dedup,
    "op6_embedding_dup": op6_embedding_dup,
    "op7_pii": op7_pii,
    "op8_language": op8_language,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_quality": op10_quality,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_licenses": op13_licenses,
}

ORACLES: dict[str, str] = {
    "op2_near_dup": OP2_SQL,
    "op4_mixing": OP4_SQL,
    "op6_embedding_dup": OP6_SQL,
    "op11_conversation_repair": OP11_SQL,
    "op13_licenses": OP13_SQL,
}

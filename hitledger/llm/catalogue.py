"""The queries of this subpackage and the SQL that checks them."""

from __future__ import annotations

from hitledger.llm.additive import op12_quality_classifier
from hitledger.llm.bpe import op1_byte_bpe
from hitledger.llm.brown import op2_brown_scores
from hitledger.llm.conversations import OP13_SQL, op13_conversation_repair
from hitledger.llm.filteraudit import OP11_SQL, op11_filter_audit
from hitledger.llm.language import op7_language
from hitledger.llm.licenses import OP4_SQL, op4_license_scan
from hitledger.llm.linededup import OP3_SQL, op3_line_dedup
from hitledger.llm.mixing import OP10_SQL, op10_mix_sources
from hitledger.llm.neardup import op9_near_duplicates
from hitledger.llm.quality import OP5_SQL, op5_quality_rules
from hitledger.llm.vectors import op8_near_vectors
from hitledger.llm.warc import OP6_SQL, op6_warc

QUERIES = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_brown_scores": op2_brown_scores,
    "op3_line_dedup": op3_line_dedup,
    "op4_license_scan": op4_license_scan,
    "op5_quality_rules": op5_quality_rules,
    "op6_warc": op6_warc,
    "op7_language": op7_language,
    "op8_near_vectors": op8_near_vectors,
    "op9_near_duplicates": op9_near_duplicates,
    "op10_mix_sources": op10_mix_sources,
    "op11_filter_audit": op11_filter_audit,
    "op12_quality_classifier": op12_quality_classifier,
    "op13_conversation_repair": op13_conversation_repair,
}
SQL = {
    "op4_license_scan": OP4_SQL,
    "op3_line_dedup": OP3_SQL,
    "op5_quality_rules": OP5_SQL,
    "op6_warc": OP6_SQL,
    "op10_mix_sources": OP10_SQL,
    "op11_filter_audit": OP11_SQL,
    "op13_conversation_repair": OP13_SQL,
}

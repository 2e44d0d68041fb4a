"""The queries of the training-data operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from bondmart.llm.alignment import op11_alignment
from bondmart.llm.bpe_trie import op13_bpe_trie
from bondmart.llm.decontaminate import op9_decontaminate
from bondmart.llm.kd_search import OP6_SQL, op6_kd_search
from bondmart.llm.language import op4_language
from bondmart.llm.sentencepiece_op import op7_sentencepiece
from bondmart.llm.repair import op12_conversation_repair
from bondmart.llm.simhash import op8_simhash
from bondmart.llm.substring_dedup import op3_substring_dedup
from bondmart.llm.token_counts import op2_token_counts
from bondmart.llm.toxicity import op5_toxicity
from bondmart.llm.url_filter import OP10_SQL, op10_url_filter
from bondmart.llm.warc_op import OP1_SQL, op1_warc

QUERIES = {f.__name__: f for f in (
    op1_warc,
    op2_token_counts,
    op3_substring_dedup,
    op4_language,
    op5_toxicity,
    op6_kd_search,
    op7_sentencepiece,
    op8_simhash,
    op9_decontaminate,
    op10_url_filter,
    op11_alignment,
    op12_conversation_repair,
    op13_bpe_trie,
)}

SQL: dict[str, str] = {
    "op1_warc": OP1_SQL,
    "op6_kd_search": OP6_SQL,
    "op10_url_filter": OP10_SQL,
}

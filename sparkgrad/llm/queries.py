"""Queries of the operators, with their SQL where SQL can express them."""

from __future__ import annotations

from sparkgrad.llm.alignment import op13_alignment
from sparkgrad.llm.bpe import op6_bpe
from sparkgrad.llm.embedding_pairs import OP3_SQL, op3_embedding_pairs
from sparkgrad.llm.html_text import op5_html_blocks
from sparkgrad.llm.langid import op10_language_id
from sparkgrad.llm.line_crf import op4_line_crf
from sparkgrad.llm.mixing import op8_mixing
from sparkgrad.llm.quality_rules import OP7_SQL, op7_quality_rules
from sparkgrad.llm.resampling import OP12_SQL, op12_resampling
from sparkgrad.llm.sharding import op1_sharding
from sparkgrad.llm.simhash import op2_simhash
from sparkgrad.llm.suffix_dedup import op9_suffix_dedup
from sparkgrad.llm.token_files import op11_token_files

QUERIES = {q.__name__: q for q in (
    op1_sharding, op2_simhash, op3_embedding_pairs, op4_line_crf, op5_html_blocks, op6_bpe, op7_quality_rules, op8_mixing,
    op9_suffix_dedup, op10_language_id, op11_token_files, op12_resampling, op13_alignment)}
SQL = {"op3_embedding_pairs": OP3_SQL, "op7_quality_rules": OP7_SQL, "op12_resampling": OP12_SQL}

"""The corpus operators' queries, by name, and the SQL that checks those SQL can express."""

from __future__ import annotations

from chemprobe.llm.bpe import op9_bpe
from chemprobe.llm.exact_dedup import OP8_SQL, op8_exact_dedup
from chemprobe.llm.html_extract import op1_html_extraction
from chemprobe.llm.ngram_join import OP2_SQL, op2_ngram_join
from chemprobe.llm.packing import op5_packing
from chemprobe.llm.quality_classifier import op6_quality_classifier
from chemprobe.llm.quality_rules import OP3_SQL, op3_quality_rules
from chemprobe.llm.range_coder import op10_token_output
from chemprobe.llm.sharding import op4_sharding
from chemprobe.llm.suffix_dedup import op7_suffix_dedup

QUERIES = {
    "op1_html_extraction": op1_html_extraction,
    "op2_ngram_join": op2_ngram_join,
    "op3_quality_rules": op3_quality_rules,
    "op4_sharding": op4_sharding,
    "op5_packing": op5_packing,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_bpe": op9_bpe,
    "op10_token_output": op10_token_output,
}

SQL: dict[str, str] = {"op2_ngram_join": OP2_SQL, "op3_quality_rules": OP3_SQL, "op8_exact_dedup": OP8_SQL}

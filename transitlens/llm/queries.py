"""Registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from .bpe import op6_byte_bpe
from .chat import op7_chat_format
from .decontaminate import op3_benchmark_decontamination
from .exact_dedup import op12_exact_dedup
from .hard_negatives import op13_hard_negatives
from .html_extract import op8_html_extraction
from .line_dedup import op10_line_dedup
from .minhash import op4_minhash_near_dedup
from .oracles import ORACLE
from .quality import op5_quality_rules
from .secrets import op1_secret_scan
from .suffix_dedup import op2_suffix_dedup
from .token_align import op11_tokenizer_alignment
from .window_dedup import op9_substring_dedup

__all__ = ["ORACLE", "QUERIES"]

QUERIES = {
    "op1_secret_scan": op1_secret_scan,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_benchmark_decontamination": op3_benchmark_decontamination,
    "op4_minhash_near_dedup": op4_minhash_near_dedup,
    "op5_quality_rules": op5_quality_rules,
    "op6_byte_bpe": op6_byte_bpe,
    "op7_chat_format": op7_chat_format,
    "op8_html_extraction": op8_html_extraction,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_line_dedup": op10_line_dedup,
    "op11_tokenizer_alignment": op11_tokenizer_alignment,
    "op12_exact_dedup": op12_exact_dedup,
    "op13_hard_negatives": op13_hard_negatives,
}


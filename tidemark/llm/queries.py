"""Registered queries of this folder and their SQL."""

from __future__ import annotations

from .op1_source_mixing import op1_source_mixing
from .op2_fm_dedup import op2_fm_dedup
from .op3_suffix_dedup import op3_suffix_dedup
from .op4_url_filter import OP4_SQL, op4_url_filter
from .op5_learned_partitions import op5_learned_partitions
from .op6_language_id import op6_language_id
from .op7_lm_scoring import op7_lm_scoring
from .op8_jaccard_join import op8_jaccard_join
from .op9_binary_output import op9_binary_output
from .op10_decontamination import op10_decontamination
from .op11_fill_in_middle import OP11_SQL, op11_fill_in_middle
from .op12_spelling_variants import op12_spelling_variants
from .op13_cover_tree_dedup import OP13_SQL, op13_cover_tree_dedup


def queries() -> dict:
    return {
        "op1_source_mixing": op1_source_mixing,
        "op2_fm_dedup": op2_fm_dedup,
        "op3_suffix_dedup": op3_suffix_dedup,
        "op4_url_filter": op4_url_filter,
        "op5_learned_partitions": op5_learned_partitions,
        "op6_language_id": op6_language_id,
        "op7_lm_scoring": op7_lm_scoring,
        "op8_jaccard_join": op8_jaccard_join,
        "op9_binary_output": op9_binary_output,
        "op10_decontamination": op10_decontamination,
        "op11_fill_in_middle": op11_fill_in_middle,
        "op12_spelling_variants": op12_spelling_variants,
        "op13_cover_tree_dedup": op13_cover_tree_dedup,
    }


def oracle_sql() -> dict:
    return {
        "op4_url_filter": OP4_SQL,
        "op11_fill_in_middle": OP11_SQL,
        "op13_cover_tree_dedup": OP13_SQL,
    }

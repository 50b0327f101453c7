"""The queries of this subpackage, for the driver's contract."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .ann import op10_multiprobe_ann
from .fill_middle import op12_fill_middle
from .importance import op11_importance_resampling
from .lattice import op7_piece_sampling
from .licenses import op5_license_scan
from .main_text import op13_consensus_main_text
from .ngram_join import op8_ngram_jaccard_join
from .oracles import ORACLES
from .packing import op3_vector_packing
from .quality import op9_quality_rules
from .substring import op2_substring_dedup
from .suffix_tree import op1_suffix_tree_scores
from .toxicity import op4_weak_supervision_toxicity
from .warc import op6_warc_index_merge

__all__ = ["ORACLES", "QUERIES"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_tree_scores": op1_suffix_tree_scores,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_vector_packing": op3_vector_packing,
    "op4_weak_supervision_toxicity": op4_weak_supervision_toxicity,
    "op5_license_scan": op5_license_scan,
    "op6_warc_index_merge": op6_warc_index_merge,
    "op7_piece_sampling": op7_piece_sampling,
    "op8_ngram_jaccard_join": op8_ngram_jaccard_join,
    "op9_quality_rules": op9_quality_rules,
    "op10_multiprobe_ann": op10_multiprobe_ann,
    "op11_importance_resampling": op11_importance_resampling,
    "op12_fill_middle": op12_fill_middle,
    "op13_consensus_main_text": op13_consensus_main_text,
}

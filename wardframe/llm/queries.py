"""Registered queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from wardframe.llm.concat_packing import op11_concat_packing
from wardframe.llm.decontamination import op4_benchmark_decontamination
from wardframe.llm.lexical_search import OP13_SQL, op13_ranked_search
from wardframe.llm.lm_scoring import op7_lm_scoring
from wardframe.llm.ngram_join import OP5_SQL, op5_ngram_jaccard_join
from wardframe.llm.packing import op1_best_fit_packing
from wardframe.llm.quality_classifier import op6_quality_classifier
from wardframe.llm.quality_rules import op10_robust_outliers
from wardframe.llm.sharding import op8_shuffled_shards
from wardframe.llm.substring_dedup import OP2_SQL, op2_substring_dedup
from wardframe.llm.token_counts import op9_token_counts
from wardframe.llm.token_alignment import op12_token_alignment
from wardframe.llm.toxicity import op3_toxicity

QUERIES = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_toxicity": op3_toxicity,
    "op4_benchmark_decontamination": op4_benchmark_decontamination,
    "op5_ngram_jaccard_join": op5_ngram_jaccard_join,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_lm_scoring": op7_lm_scoring,
    "op8_shuffled_shards": op8_shuffled_shards,
    "op9_token_counts": op9_token_counts,
    "op10_robust_outliers": op10_robust_outliers,
    "op11_concat_packing": op11_concat_packing,
    "op12_token_alignment": op12_token_alignment,
    "op13_ranked_search": op13_ranked_search,
}

ORACLES = {
    "op2_substring_dedup": OP2_SQL,
    "op5_ngram_jaccard_join": OP5_SQL,
    "op13_ranked_search": OP13_SQL,
}

"""The queries of this package, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .counts import op1_offset_attribution
from .html import op3_inferred_wrappers
from .merkle import OP11_SQL, op11_merkle_tree
from .mixing import op5_hypergeometric_mix
from .neardup import op7_order_minhash
from .packing import op4_best_fit_decreasing
from .pii import op9_boosted_candidates
from .quality import op8_weak_supervision
from .secrets import op6_multipart_secrets
from .sharding import op2_sampled_splitters
from .spelling import OP13_SQL, op13_anagram_hashing
from .topk import OP10_SQL, op10_uniform_threshold
from .whitening import op12_lobpcg_whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_offset_attribution": op1_offset_attribution,
    "op2_sampled_splitters": op2_sampled_splitters,
    "op3_inferred_wrappers": op3_inferred_wrappers,
    "op4_best_fit_decreasing": op4_best_fit_decreasing,
    "op5_hypergeometric_mix": op5_hypergeometric_mix,
    "op6_multipart_secrets": op6_multipart_secrets,
    "op7_order_minhash": op7_order_minhash,
    "op8_weak_supervision": op8_weak_supervision,
    "op9_boosted_candidates": op9_boosted_candidates,
    "op10_uniform_threshold": op10_uniform_threshold,
    "op11_merkle_tree": op11_merkle_tree,
    "op12_lobpcg_whitening": op12_lobpcg_whitening,
    "op13_anagram_hashing": op13_anagram_hashing,
}
ORACLE_SQL: dict[str, str] = {"op10_uniform_threshold": OP10_SQL, "op11_merkle_tree": OP11_SQL, "op13_anagram_hashing": OP13_SQL}

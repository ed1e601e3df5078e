"""The registered queries of the training-data operators, with DuckDB SQL where that can express them."""

from __future__ import annotations

from tidings.llm import (best_fit_packing, host_suffix_html, hyperplane_tree, jacobi_davidson, kdtree_search, minhash_forest, projection_passes,
                         quality_rules, substring_dedup, suffix_dedup, suffix_tree_lm, toxicity_fm, unigram_pieces)

QUERIES = {
    "op1_best_fit_packing": best_fit_packing.query,
    "op2_substring_dedup": substring_dedup.query,
    "op3_quality_rules": quality_rules.query,
    "op4_kdtree_search": kdtree_search.query,
    "op5_unigram_pieces": unigram_pieces.query,
    "op6_minhash_forest": minhash_forest.query,
    "op7_toxicity_fm": toxicity_fm.query,
    "op8_host_suffix_html": host_suffix_html.query,
    "op9_suffix_dedup": suffix_dedup.query,
    "op10_suffix_tree_lm": suffix_tree_lm.query,
    "op11_jacobi_davidson": jacobi_davidson.query,
    "op12_hyperplane_tree": hyperplane_tree.query,
    "op13_projection_passes": projection_passes.query,
}

ORACLES: dict[str, str] = {
    "op2_substring_dedup": substring_dedup.ORACLE,
    "op6_minhash_forest": minhash_forest.ORACLE,
    "op8_host_suffix_html": host_suffix_html.ORACLE,
    "op9_suffix_dedup": suffix_dedup.ORACLE,
    "op4_kdtree_search": kdtree_search.ORACLE,
    "op12_hyperplane_tree": hyperplane_tree.ORACLE,
}

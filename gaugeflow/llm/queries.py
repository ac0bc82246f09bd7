"""The queries of this package and their SQL, by name."""

from . import bitplanes, context_tree, exact_dedup, fingerprint, mixing, packing, pii, projection_forest, quality, shingle_join, spelling, url_filter, whitening

QUERIES = {
    "op1_pii": pii.pii,
    "op2_fingerprints": fingerprint.fingerprints,
    "op3_quality_classifier": quality.quality_classifier,
    "op4_shingle_join": shingle_join.shingle_join,
    "op5_url_filters": url_filter.url_filters,
    "op6_exact_dedup": exact_dedup.exact_dedup,
    "op7_token_store": bitplanes.token_store,
    "op8_lm_scoring": context_tree.lm_scores,
    "op9_mixing": mixing.mixing,
    "op10_best_fit_packing": packing.best_fit_packing,
    "op11_spelling_variants": spelling.spelling_variants,
    "op12_near_embeddings": projection_forest.near_embeddings,
    "op13_whitening": whitening.whitening,
}
SQL = {"op6_exact_dedup": exact_dedup.SQL, "op12_near_embeddings": projection_forest.SQL}

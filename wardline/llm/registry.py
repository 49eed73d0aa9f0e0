"""The queries of this folder, and the DuckDB counterparts of those that SQL can express."""

from wardline.llm import bpe, decontamination, fingerprints, hard_negatives, hidden_markov, jaccard_join, language_id, mixing, secret_scans, sharding, token_alignment, token_files, url_filters

QUERIES = {
    "op1_secret_scans": secret_scans.op1_secret_scans,
    "op2_sharding": sharding.op2_sharding,
    "op3_hidden_markov": hidden_markov.op3_hidden_markov,
    "op4_jaccard_join": jaccard_join.op4_jaccard_join,
    "op5_fingerprints": fingerprints.op5_fingerprints,
    "op6_token_files": token_files.op6_token_files,
    "op7_language_id": language_id.op7_language_id,
    "op8_decontamination": decontamination.op8_decontamination,
    "op9_bpe": bpe.op9_bpe,
    "op10_url_filters": url_filters.op10_url_filters,
    "op11_hard_negatives": hard_negatives.op11_hard_negatives,
    "op12_token_alignment": token_alignment.op12_token_alignment,
    "op13_mixing": mixing.op13_mixing,
}

ORACLES = {
    "op4_jaccard_join": jaccard_join.ORACLE_SQL,
    "op8_decontamination": decontamination.ORACLE_SQL,
    "op10_url_filters": url_filters.ORACLE_SQL,
    "op11_hard_negatives": hard_negatives.ORACLE_SQL,
}

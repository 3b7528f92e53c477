"""Queries of this subpackage: name -> (spark, sf_dir) -> DataFrame, and DuckDB SQL where it can express them."""

from __future__ import annotations

from servstar.llm import exact_dedup, hard_negatives, lattice, mixing, packing, periodic, quality, secrets, sharding, simhash, substring_dedup, suffix_dedup, token_files

QUERIES = {
    "op1_simhash": simhash.op1_simhash,
    "op2_lattice": lattice.op2_lattice,
    "op3_packing": packing.op3_packing,
    "op4_markov_secrets": secrets.op4_markov_secrets,
    "op5_mixing": mixing.op5_mixing,
    "op6_quality_classifier": quality.op6_quality_classifier,
    "op7_hilbert_sharding": sharding.op7_hilbert_sharding,
    "op8_suffix_radix": suffix_dedup.op8_suffix_radix,
    "op9_difference_cover": substring_dedup.op9_difference_cover,
    "op10_exact_dedup": exact_dedup.op10_exact_dedup,
    "op11_periodic_runs": periodic.op11_periodic_runs,
    "op12_hard_negatives": hard_negatives.op12_hard_negatives,
    "op13_token_frames": token_files.op13_token_frames,
}
ORACLE_SQL = {
    "op2_lattice": lattice.ORACLE,
    "op5_mixing": mixing.ORACLE,
    "op9_difference_cover": substring_dedup.ORACLE,
    "op10_exact_dedup": exact_dedup.ORACLE,
    "op12_hard_negatives": hard_negatives.ORACLE,
}

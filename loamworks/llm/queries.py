"""One query for each operator of this subpackage, over its whole table with production parameters."""

from __future__ import annotations

from loamworks.llm import decontaminate, lattice_lm, license_scan, piece_sampling, quality_gam, rotated_codes, sharding, simhash_ball, token_packing, toxicity_pu

QUERIES = {
    "op1_token_packing": token_packing.query,
    "op2_simhash_ball": simhash_ball.query,
    "op3_sharding": sharding.query,
    "op4_rotated_codes": rotated_codes.query,
    "op5_toxicity_pu": toxicity_pu.query,
    "op6_license_scan": license_scan.query,
    "op7_decontaminate": decontaminate.query,
    "op8_piece_sampling": piece_sampling.query,
    "op9_quality_gam": quality_gam.query,
    "op10_lattice_lm": lattice_lm.query,
}
ORACLES = {"op3_sharding": sharding.ORACLE_SQL, "op4_rotated_codes": rotated_codes.ORACLE_SQL}

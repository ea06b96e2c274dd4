"""Registered queries of the corpus operators and their DuckDB SQL."""

from __future__ import annotations

from wakeline.llm.bpe import op10_bpe_tree
from wakeline.llm.decontam import op2_spaced_seed_leaks
from wakeline.llm.license_scan import op5_license_scan
from wakeline.llm.lm_score import op7_pitman_yor_lm
from wakeline.llm.manifest import OP12_SQL, op12_postorder_manifest
from wakeline.llm.near_dup import op9_dart_minhash
from wakeline.llm.pii import op13_boosted_pii
from wakeline.llm.quality_model import op4_ordinal_quality
from wakeline.llm.quality_rules import OP8_SQL, op8_quality_rules
from wakeline.llm.resample import OP11_SQL, op11_crc_resample
from wakeline.llm.sharding import OP3_SQL, op3_byte_shards
from wakeline.llm.suffix_dedup import op1_suffix_dedup
from wakeline.llm.tables import ship_package
from wakeline.llm.url_filter import OP6_SQL, op6_url_filter



def _shipped(query):
    def run(spark, sf_dir):
        ship_package(spark)
        return query(spark, sf_dir)
    return run


QUERIES = {name: _shipped(query) for name, query in {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_spaced_seed_leaks": op2_spaced_seed_leaks,
    "op3_byte_shards": op3_byte_shards,
    "op4_ordinal_quality": op4_ordinal_quality,
    "op5_license_scan": op5_license_scan,
    "op6_url_filter": op6_url_filter,
    "op7_pitman_yor_lm": op7_pitman_yor_lm,
    "op8_quality_rules": op8_quality_rules,
    "op9_dart_minhash": op9_dart_minhash,
    "op10_bpe_tree": op10_bpe_tree,
    "op11_crc_resample": op11_crc_resample,
    "op12_postorder_manifest": op12_postorder_manifest,
    "op13_boosted_pii": op13_boosted_pii,
}.items()}

ORACLE_SQL = {
    "op3_byte_shards": OP3_SQL,
    "op6_url_filter": OP6_SQL,
    "op8_quality_rules": OP8_SQL,
    "op11_crc_resample": OP11_SQL,
    "op12_postorder_manifest": OP12_SQL,
}

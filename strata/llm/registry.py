"""Queries of the corpus operators and their SQL."""

from strata.llm import (bpe, conversation_repair, decontamination, exact_dedup, hard_negatives, license_scan, line_dedup, ngram_join, pii,
                        quality_rules, sharding, suffix_dedup, warc)

QUERIES = {
    "op1_quality_rules": quality_rules.query,
    "op2_sharding": sharding.query,
    "op3_decontamination": decontamination.query,
    "op4_pii": pii.query,
    "op5_license_scan": license_scan.query,
    "op6_line_dedup": line_dedup.query,
    "op7_ngram_join": ngram_join.query,
    "op8_warc": warc.query,
    "op9_bpe": bpe.query,
    "op10_suffix_dedup": suffix_dedup.query,
    "op11_conversation_repair": conversation_repair.query,
    "op12_hard_negatives": hard_negatives.query,
    "op13_exact_dedup": exact_dedup.query,
}
ORACLE = {
    "op1_quality_rules": quality_rules.SQL,
    "op5_license_scan": license_scan.SQL,
    "op6_line_dedup": line_dedup.SQL,
    "op7_ngram_join": ngram_join.SQL,
    "op8_warc": warc.SQL,
    "op10_suffix_dedup": suffix_dedup.SQL,
    "op12_hard_negatives": hard_negatives.SQL,
    "op13_exact_dedup": exact_dedup.SQL,
}

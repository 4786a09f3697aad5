"""Queries of the training-data operators and their SQL."""

from __future__ import annotations

from . import byte_bpe, decontaminate, exact_dedup, html_extract, language_id, pii, quality, simhash, toxicity, warc

QUERIES = {
    "op1_language_id": language_id.op1_language_id,
    "op2_warc": warc.op2_warc,
    "op3_toxicity": toxicity.op3_toxicity,
    "op4_quality_classifier": quality.op4_quality_classifier,
    "op5_benchmark_decontamination": decontaminate.op5_benchmark_decontamination,
    "op6_exact_dedup": exact_dedup.op6_exact_dedup,
    "op10_byte_bpe": byte_bpe.op10_byte_bpe,
    "op7_html_extraction": html_extract.op7_html_extraction,
    "op8_pii": pii.op8_pii,
    "op9_simhash_near_dedup": simhash.op9_simhash_near_dedup,
}
SQL = {"op2_warc": warc.SQL, "op5_benchmark_decontamination": decontaminate.SQL, "op6_exact_dedup": exact_dedup.SQL}

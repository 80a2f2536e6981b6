"""Queries of the subpackage, for ``__spark_entry__``."""

from __future__ import annotations

from . import (bpe, decontaminate, exact_dedup, langid, line_dedup, orchard, quality, secrets, simhash, substring_dedup,
               surrogates, toxicity, variants)

QUERIES = {
    "op1_secret_scan": secrets.op1_secret_scan,
    "op2_pii_surrogates": surrogates.op2_pii_surrogates,
    "op3_byte_bpe": bpe.op3_byte_bpe,
    "op4_language_id": langid.op4_language_id,
    "op5_line_dedup": line_dedup.op5_line_dedup,
    "op6_simhash": simhash.op6_simhash,
    "op7_decontaminate": decontaminate.op7_decontaminate,
    "op8_quality": quality.op8_quality,
    "op9_exact_dedup": exact_dedup.op9_exact_dedup,
    "op10_suffix_array_dedup": substring_dedup.op10_suffix_array_dedup,
    "op11_spelling_variants": variants.op11_spelling_variants,
    "op12_toxicity": toxicity.op12_toxicity,
    "op13_centroid_clustering": orchard.op13_centroid_clustering,
}

#: DuckDB SQL of the queries that SQL can express on whole tables.
ORACLE_SQL = {
    "op9_exact_dedup": exact_dedup.ORACLE_SQL,
    "op13_centroid_clustering": orchard.ORACLE_SQL,
}

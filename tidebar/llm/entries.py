"""Queries of this folder, by name, and their SQL where SQL can express them."""

from __future__ import annotations

from . import exact_dedup, html_extract, langid, licenses, mixing, near_dedup, nn_descent, packing, quality, substring_dedup

QUERIES = {
    "op1_language_id": langid.op1_language_id,
    "op2_near_dedup": near_dedup.op2_near_dedup,
    "op3_quality": quality.op3_quality,
    "op4_entropy_mix": mixing.op4_entropy_mix,
    "op5_html_extraction": html_extract.op5_html_extraction,
    "op6_nearest_neighbours": nn_descent.op6_nearest_neighbours,
    "op7_license_scan": licenses.op7_license_scan,
    "op8_packing": packing.op8_packing,
    "op9_substring_dedup": substring_dedup.op9_substring_dedup,
    "op10_exact_dedup": exact_dedup.op10_exact_dedup,
}
SQL = {"op10_exact_dedup": exact_dedup.OP10_SQL}

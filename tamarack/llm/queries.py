"""Queries opN_<name> of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from .bpe_duckdb import op7_bpe_duckdb
from .exact_dedup import OP5_SQL, op5_exact_dedup
from .fingerprints import op2_fingerprints
from .html_extract import op3_html_extraction
from .importance import OP12_SQL, op12_importance_resampling
from .order_minhash import op6_order_minhash
from .packing import op1_best_fit_packing
from .personal_data import OP13_SQL, op13_personal_data
from .quality import op9_quality_classifier
from .spelling import OP11_SQL, op11_spelling_variants
from .substring_dedup import op10_substring_dedup
from .token_counts import op4_token_counts
from .warc import OP8_SQL, op8_warc

QUERIES = {f.__name__: f for f in (op1_best_fit_packing, op4_token_counts, op5_exact_dedup, op7_bpe_duckdb, op2_fingerprints, op10_substring_dedup, op6_order_minhash, op9_quality_classifier, op8_warc, op3_html_extraction, op11_spelling_variants, op12_importance_resampling, op13_personal_data)}

ORACLES: dict[str, str] = {"op5_exact_dedup": OP5_SQL, "op8_warc": OP8_SQL, "op11_spelling_variants": OP11_SQL, "op12_importance_resampling": OP12_SQL, "op13_personal_data": OP13_SQL}

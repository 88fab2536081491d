"""The queries of this subpackage and the SQL that checks them, where SQL can."""

from __future__ import annotations

from . import covertree, licenses
from .automaton import op2_bpe_automaton
from .covertree import op5_exact_top_k
from .idfiles import op9_token_id_files
from .language import op6_language_id
from .licenses import op3_license_scan
from .media import op7_media_columns
from .ngramjoin import op8_ngram_jaccard_join
from .packing import op1_best_fit_packing
from .quality import op4_quality_classifier
from .substrings import op10_suffix_array_dedup

QUERIES = {f.__name__: f for f in (op1_best_fit_packing, op2_bpe_automaton, op3_license_scan, op4_quality_classifier, op5_exact_top_k, op6_language_id, op7_media_columns, op8_ngram_jaccard_join, op9_token_id_files, op10_suffix_array_dedup)}

ORACLES: dict[str, str] = {"op3_license_scan": licenses.oracle(), "op5_exact_top_k": covertree.oracle()}

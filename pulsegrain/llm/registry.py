"""Queries of this subpackage by name, and SQL for those that SQL can express."""

from __future__ import annotations

from .ann import op2_ann
from .language_id import op1_language_id
from .merkle import OP13_SQL, op13_merkle_manifest
from .ngram_join import OP12_SQL, op12_ngram_join
from .packing import op6_packing
from .periodic_runs import OP11_SQL, op11_periodic_runs
from .pii import op4_pii
from .piece_sampling import op9_piece_sampling
from .quality_classifier import op10_quality_classifier
from .quality_rules import op7_quality_rules
from .simhash import op3_simhash
from .substring_dedup import OP5_SQL, op5_substring_dedup
from .toxicity import op8_toxicity

QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_ann": op2_ann,
    "op3_simhash": op3_simhash,
    "op4_pii": op4_pii,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_packing": op6_packing,
    "op7_quality_rules": op7_quality_rules,
    "op8_toxicity": op8_toxicity,
    "op9_piece_sampling": op9_piece_sampling,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_ngram_join": op12_ngram_join,
    "op13_merkle_manifest": op13_merkle_manifest,
}
#: Words and hashes of other kinds (XXH64, token ids), and trained models, are
#: not expressible; those queries are tested against brute force.
ORACLE_SQL: dict[str, str] = {"op5_substring_dedup": OP5_SQL, "op11_periodic_runs": OP11_SQL, "op12_ngram_join": OP12_SQL, "op13_merkle_manifest": OP13_SQL}

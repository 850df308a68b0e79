"""Registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from .centroid_clustering import OP13_SQL, op13_centroid_clustering
from .chat_format import OP6_SQL, op6_chat_format
from .decontaminate import OP8_SQL, op8_decontaminate
from .filter_audit import OP11_SQL, op11_filter_audit
from .fingerprint import op1_fingerprint
from .jaccard_join import OP10_SQL, op10_jaccard_join
from .language_id import op4_language_id
from .line_dedup import OP5_SQL, op5_line_dedup
from .mixing import OP7_SQL, op7_mix_sources
from .ngram_lm import op9_lm_score
from .sequence_packing import op12_pack_sequences
from .substring_dedup import OP3_SQL, op3_substring_dedup
from .token_count import op2_token_counts

QUERIES = {f.__name__: f for f in (
    op1_fingerprint, op2_token_counts, op3_substring_dedup, op4_language_id, op5_line_dedup, op6_chat_format, op7_mix_sources,
    op8_decontaminate, op9_lm_score, op10_jaccard_join, op11_filter_audit, op12_pack_sequences, op13_centroid_clustering)}
ORACLE_SQL = {"op3_substring_dedup": OP3_SQL, "op5_line_dedup": OP5_SQL, "op6_chat_format": OP6_SQL, "op7_mix_sources": OP7_SQL,
              "op8_decontaminate": OP8_SQL, "op10_jaccard_join": OP10_SQL,
              "op11_filter_audit": OP11_SQL, "op13_centroid_clustering": OP13_SQL}

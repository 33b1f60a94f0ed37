"""The queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from .contamination import op3_contamination
from .conversation_repair import op12_conversation_repair
from .license_scan import op8_licenses
from .near_duplicates import OP2_SQL, op2_minhash
from .periodic_runs import op13_periodic_runs
from .pii import op1_pii
from .quality import op4_quality
from .repeated_passages import OP11_SQL, op11_repeated_passages
from .repeated_spans import op7_repeated_spans
from .secret_scan import op10_secrets
from .sentence_pieces import op5_sentence_pieces
from .token_counts import op6_token_counts
from .token_files import op9_token_files

QUERIES = {
    "op1_pii": op1_pii,
    "op2_minhash": op2_minhash,
    "op3_contamination": op3_contamination,
    "op4_quality": op4_quality,
    "op5_sentence_pieces": op5_sentence_pieces,
    "op6_token_counts": op6_token_counts,
    "op7_repeated_spans": op7_repeated_spans,
    "op8_licenses": op8_licenses,
    "op9_token_files": op9_token_files,
    "op10_secrets": op10_secrets,
    "op11_repeated_passages": op11_repeated_passages,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_periodic_runs": op13_periodic_runs,
}

#: The others need hashes of positions, learned rules or tokenizers; their tests hold them against brute force and the libraries.
ORACLES: dict[str, str] = {"op2_minhash": OP2_SQL, "op11_repeated_passages": OP11_SQL}

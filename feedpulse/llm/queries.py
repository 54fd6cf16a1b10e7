"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from feedpulse.llm.decontaminate import OP12_SQL, op12_decontaminate
from feedpulse.llm.embedding_dedup import op8_embedding_dedup
from feedpulse.llm.exact_dedup import OP6_SQL, op6_exact_dedup
from feedpulse.llm.lexical_search import OP11_SQL, op11_lexical_search
from feedpulse.llm.license_scan import op1_license_scan
from feedpulse.llm.near_dedup import op7_near_dedup
from feedpulse.llm.packing import op10_best_fit_packing
from feedpulse.llm.piece_ids import op5_piece_ids
from feedpulse.llm.quality import op3_quality
from feedpulse.llm.secret_scan import op9_secret_scan
from feedpulse.llm.token_codes import op4_token_codes
from feedpulse.llm.warc import OP2_SQL, op2_warc
from feedpulse.llm.whitening import op13_whitening

QUERIES = {
    "op1_license_scan": op1_license_scan,
    "op2_warc": op2_warc,
    "op3_quality": op3_quality,
    "op4_token_codes": op4_token_codes,
    "op5_piece_ids": op5_piece_ids,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_near_dedup": op7_near_dedup,
    "op8_embedding_dedup": op8_embedding_dedup,
    "op9_secret_scan": op9_secret_scan,
    "op10_best_fit_packing": op10_best_fit_packing,
    "op11_lexical_search": op11_lexical_search,
    "op12_decontaminate": op12_decontaminate,
    "op13_whitening": op13_whitening,
}

#: The others are not expressible in SQL; tests/llm sets them against brute force.
ORACLES = {
    "op2_warc": OP2_SQL,
    "op6_exact_dedup": OP6_SQL,
    "op11_lexical_search": OP11_SQL,
    "op12_decontaminate": OP12_SQL,
}

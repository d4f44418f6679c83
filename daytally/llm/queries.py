"""The queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from . import (
    archives, decontamination, embeddings, filter_audit, html_text, lines, minhash, mixing, pieces, secrets, sharding,
    toxicity, whitening,
)

QUERIES = {
    f.__name__: f for f in (
        html_text.op1_html_text, secrets.op2_secrets, minhash.op3_minhash, sharding.op4_sharding,
        embeddings.op5_embeddings, toxicity.op6_toxicity, archives.op7_archives, lines.op8_lines,
        mixing.op9_mixing, decontamination.op10_decontamination, filter_audit.op11_filter_audit, pieces.op12_pieces,
        whitening.op13_whitening,
    )
}
ORACLES = {
    "op2_secrets": secrets.OP2_SQL, "op7_archives": archives.OP7_SQL, "op9_mixing": mixing.OP9_SQL,
    "op11_filter_audit": filter_audit.OP11_SQL,
}

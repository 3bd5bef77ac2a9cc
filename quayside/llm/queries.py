"""Registered queries of the training-data operators; ``SQL`` has the DuckDB SQL of those that it can express."""

from __future__ import annotations

from .bottom_k import op13
from .bpe import op5
from .chat import op8
from .hard_negatives import op11
from .host_rules import op4
from .lattice_lm import op9
from .merkle import op12
from .mixing import op2
from .pii import op6
from .repeats import op3
from .secret_scan import op1
from .simhash import op10
from .sql import SQL
from .topk import op7

QUERIES = {
    "op1_secret_scan": op1,
    "op2_mixing": op2,
    "op3_repeats": op3,
    "op4_host_rules": op4,
    "op5_bpe": op5,
    "op6_pii": op6,
    "op7_topk": op7,
    "op8_chat": op8,
    "op9_lattice_lm": op9,
    "op10_simhash": op10,
    "op11_hard_negatives": op11,
    "op12_merkle": op12,
    "op13_bottom_k": op13,
}

__all__ = ["QUERIES", "SQL"]

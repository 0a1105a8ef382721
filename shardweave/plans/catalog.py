"""All core queries and their SQL twins, collected by module."""

from __future__ import annotations

from . import q_files, q_more, q_samples, q_stream, q_tokens
from .q_tokens import flagship  # noqa: F401 - the entry query

MODULES = (q_files, q_tokens, q_samples, q_stream, q_more)
QUERIES = {k: v for m in MODULES for k, v in m.QUERIES.items()}
ORACLES = {k: v for m in MODULES for k, v in m.ORACLES.items()}

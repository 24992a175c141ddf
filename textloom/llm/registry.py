"""Queries of this package and their SQL, for the driver's registry."""

from . import q_bpe, q_licenses, q_lines, q_mixing, q_near, q_quality, q_toxicity, q_vectors, q_warc

_MODULES = (q_licenses, q_lines, q_vectors, q_toxicity, q_near, q_warc, q_mixing, q_quality, q_bpe)


def queries() -> dict:
    return {k: f for m in _MODULES for k, f in m.QUERIES.items()}


def oracle_sql() -> dict:
    return {k: s for m in _MODULES for k, s in getattr(m, "SQL", {}).items()}

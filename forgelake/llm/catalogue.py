"""All queries on text and their SQL."""

from forgelake.llm import p1_pii, p3_chrome, p4_truncation, p8_tokens, p9_mixing, p10_residue

_PARTS = (p1_pii, p3_chrome, p4_truncation, p8_tokens, p9_mixing, p10_residue)

QUERIES = {name: q for part in _PARTS for name, q in part.QUERIES.items()}
SQL = {name: q for part in _PARTS for name, q in part.SQL.items()}

"""The queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from . import byte_bpe, centroids, codebooks, embeddings, language, media, minhash, mixing, ngram_score, pieces, sharding, substrings, warc

#: Modules that have QUERIES, and perhaps ORACLE_SQL.
MODULES = (minhash, ngram_score, pieces, warc, substrings, language, sharding, mixing, embeddings, media, byte_bpe, centroids, codebooks)


def _merged(name: str) -> dict:
    return {k: v for m in MODULES for k, v in getattr(m, name, {}).items()}


def queries() -> dict:
    return _merged("QUERIES")


def oracle_sql() -> dict[str, str]:
    return _merged("ORACLE_SQL")

"""All training-data queries with their SQL, where SQL can express them."""

from __future__ import annotations

from . import archives, byte_bpe, collocations, extraction, licences, near_dups, neighbours, packing, passages, quality, sharding, token_files, vector_codes

MODULES = [token_files, extraction, quality, passages, near_dups, sharding, byte_bpe, neighbours, licences, packing, archives, vector_codes, collocations]


def load() -> tuple[dict, dict]:
    import corpus_pipeline

    queries, oracles = {}, {}
    for module in MODULES:
        queries.update(module.QUERIES)
        oracles.update(module.ORACLES)
    queries["pipeline"] = corpus_pipeline.run
    if corpus_pipeline.ORACLE_SQL:
        oracles["pipeline"] = corpus_pipeline.ORACLE_SQL
    return queries, oracles

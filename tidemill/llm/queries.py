"""The registered queries of the corpus operators and their DuckDB oracles."""

from __future__ import annotations

import corpus_pipeline

from . import ann, binout, bpe, exact, negatives, packing, phrases, quality, secrets, sharding, simhash, substring, urls

QUERIES = {
    f.__name__: f
    for f in (
        substring.op1_substring_dedup, exact.op2_exact_dedup, secrets.op3_secret_scan, sharding.op4_sharding, ann.op5_nearest_neighbours,
        simhash.op6_simhash_near_dedup, quality.op7_quality_classifier, bpe.op8_byte_bpe, packing.op9_packing, binout.op10_binary_output,
        urls.op11_url_filter, negatives.op12_hard_negatives, phrases.op13_phrase_mining,
    )
} | {"pipeline": corpus_pipeline.run}
ORACLE_SQL: dict[str, str] = exact.ORACLE | substring.ORACLE | urls.ORACLE | negatives.ORACLE | phrases.ORACLE

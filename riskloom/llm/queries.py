"""The registered queries of the operators and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from riskloom.llm import (
    bpe,
    embedding_dedup,
    fingerprint,
    language,
    line_dedup,
    minhash,
    mixing,
    periodic,
    pii,
    quality,
    spelling,
    url_filter,
    warc,
)


def llm_queries() -> dict[str, Callable]:
    found = [
        line_dedup.op1_line_dedup,
        language.op2_language,
        mixing.op3_mixing,
        quality.op4_quality,
        minhash.op5_minhash,
        pii.op6_pii,
        url_filter.op7_url_filter,
        embedding_dedup.op8_embedding_dedup,
        bpe.op9_bpe,
        fingerprint.op10_fingerprints,
        periodic.op11_periodic,
        spelling.op12_spelling,
        warc.op13_warc,
    ]
    return {query.__name__: query for query in found}


def llm_oracles() -> dict[str, str]:
    return {
        "op1_line_dedup": line_dedup.ORACLE,
        "op3_mixing": mixing.ORACLE,
        "op5_minhash": minhash.ORACLE,
        "op7_url_filter": url_filter.ORACLE,
        "op8_embedding_dedup": embedding_dedup.ORACLE,
        "op11_periodic": periodic.ORACLE,
        "op12_spelling": spelling.ORACLE,
        "op13_warc": warc.ORACLE,
    }

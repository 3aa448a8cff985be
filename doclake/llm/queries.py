"""Queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from doclake.llm import decontaminate, digests, jaccard, lloyd, mixing, packing, passages, pii, shards, strata, topk, toxicity, warc

_QUERIES: dict[str, tuple[Callable, str | None]] = {
    "op1_pii": (pii.op1_pii, None),
    "op2_warc": (warc.op2_warc, warc.ORACLE_SQL),
    "op3_decontaminate": (decontaminate.op3_decontaminate, decontaminate.ORACLE_SQL),
    "op4_jaccard": (jaccard.op4_jaccard, jaccard.ORACLE_SQL),
    "op5_sharding": (shards.op5_sharding, None),
    "op6_passages": (passages.op6_passages, None),
    "op7_mixing": (mixing.op7_mixing, None),
    "op8_topk": (topk.op8_topk, topk.ORACLE_SQL),
    "op9_packing": (packing.op9_packing, None),
    "op10_toxicity": (toxicity.op10_toxicity, None),
    "op11_ranked_search": (strata.op11_ranked_search, strata.ORACLE_SQL),
    "op12_vector_codes": (lloyd.op12_vector_codes, lloyd.ORACLE_SQL),
    "op13_exact_dedup": (digests.op13_exact_dedup, digests.ORACLE_SQL),
}


def queries() -> dict[str, Callable]:
    return {k: v[0] for k, v in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v[1] for k, v in _QUERIES.items() if v[1] is not None}

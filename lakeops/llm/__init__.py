"""Operators for large-scale training-data pipelines. Nothing else in the library
imports this package. ``QUERIES`` and ``ORACLES`` bind them to the shared tables."""

from __future__ import annotations

from lakeops.llm import binpack, decontaminate, fertility, fim, langid, linededup, merkle, minhash, packing, substrings, toxicity, trainorder, warc

_BOUND = {
    "op1_training_order": trainorder,
    "op2_decontaminate": decontaminate,
    "op3_line_winnowing": linededup,
    "op4_warc": warc,
    "op5_suffix_automata": substrings,
    "op6_packing": packing,
    "op7_minmax_near_dedup": minhash,
    "op8_language_filters": langid,
    "op9_token_fertility": fertility,
    "op10_ordinal_toxicity": toxicity,
    "op11_fill_in_middle": fim,
    "op12_merkle_manifest": merkle,
    "op13_bin_completion": binpack,
}

QUERIES = {name: module.query for name, module in _BOUND.items()}
ORACLES = {name: module.SQL for name, module in _BOUND.items() if module.SQL}

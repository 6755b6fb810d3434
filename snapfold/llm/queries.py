"""The registered queries of this subpackage and the SQL that some of them are held against."""

from __future__ import annotations

from ..session import importable
from . import chat, chroma, decontam, hosts, langid, mixing, passages, ranking, recurrent, repair, simhash, suffixes, warc

_QUERIES = {
    "op1_chroma_fingerprints": chroma.query,
    "op2_chat_format": chat.query,
    "op3_latent_decontamination": decontam.query,
    "op4_mix_sources": mixing.query,
    "op5_gru_score": recurrent.query,
    "op6_byte_convnet": langid.query,
    "op7_suffix_dedup": suffixes.query,
    "op8_warc": warc.query,
    "op9_simhash_bktree": simhash.query,
    "op10_compact_windows": passages.query,
    "op11_host_reputation": hosts.query,
    "op12_accumulator_ranking": ranking.query,
    "op13_conversation_repair": repair.query,
}


def _ready(query):
    return lambda spark, sf_dir: query(importable(spark), sf_dir)


QUERIES = {name: _ready(query) for name, query in _QUERIES.items()}

ORACLES = {
    "op2_chat_format": chat.SQL,
    "op4_mix_sources": mixing.SQL,
    "op8_warc": warc.SQL,
    "op11_host_reputation": hosts.SQL,
    "op12_accumulator_ranking": ranking.SQL,
}

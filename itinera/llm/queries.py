"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from itinera.llm import (alignment, ann, decontam, langid, licences, minhash, packing, pieces, pii, quality, repeats,
                         sharding, whitening)

QUERIES = {
    "op1_pii": pii.op1_pii,
    "op2_sharding": sharding.op2_sharding,
    "op3_langid": langid.op3_langid,
    "op4_licences": licences.op4_licences,
    "op5_decontam": decontam.op5_decontam,
    "op6_minhash": minhash.op6_minhash,
    "op7_repeats": repeats.op7_repeats,
    "op8_ann": ann.op8_ann,
    "op9_pieces": pieces.op9_pieces,
    "op10_quality": quality.op10_quality,
    "op11_alignment": alignment.op11_alignment,
    "op12_packing": packing.op12_packing,
    "op13_whitening": whitening.op13_whitening,
}

SQL = {
    "op4_licences": licences.OP4_SQL,
    "op5_decontam": decontam.OP5_SQL,
    "op6_minhash": minhash.OP6_SQL,
    "op8_ann": ann.OP8_SQL,
}

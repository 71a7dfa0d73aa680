"""The registered queries of the numbered operators and their SQL where SQL can express them."""

from __future__ import annotations

from . import infilling, langid, mixing, packing, piecewise, quality, resampling, rules, secrets, simhash, substring, topk, warc

QUERIES = {
    "op1_topk": topk.op1_topk,
    "op2_mix": mixing.op2_mix,
    "op3_simhash": simhash.op3_simhash,
    "op4_rules": rules.op4_rules,
    "op5_warc": warc.op5_warc,
    "op6_secrets": secrets.op6_secrets,
    "op7_quality": quality.op7_quality,
    "op8_language": langid.op8_language,
    "op9_substring": substring.op9_substring,
    "op10_pack": packing.op10_pack,
    "op11_resample": resampling.op11_resample,
    "op12_infilling": infilling.op12_infilling,
    "op13_pieces": piecewise.op13_pieces,
}
SQL = {
    "op1_topk": topk.OP1_SQL,
    "op2_mix": mixing.OP2_SQL,
    "op5_warc": warc.OP5_SQL,
    "op9_substring": substring.OP9_SQL,
    "op11_resample": resampling.OP11_SQL,
    "op12_infilling": infilling.OP12_SQL,
}

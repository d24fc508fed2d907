"""The operators' thin queries over the driver's tables, and their SQL where DuckDB can express it."""

from __future__ import annotations

from . import bpe, chat, divergence, jpeg, kneser_ney, licenses, minhash, mixing, pairwise, sharding, warc, wavelet, weak_rules

QUERIES = {
    "op1_mixing": mixing.query,
    "op2_licenses": licenses.query,
    "op3_kneser_ney": kneser_ney.query,
    "op4_chat": chat.query,
    "op5_bpe": bpe.query,
    "op6_jpeg": jpeg.query,
    "op7_minhash": minhash.query,
    "op8_sharding": sharding.query,
    "op9_classifier": pairwise.query,
    "op10_quality_rules": weak_rules.query,
    "op11_divergence": divergence.query,
    "op12_warc": warc.query,
    "op13_wavelet": wavelet.query,
}
ORACLE = {
    "op1_mixing": mixing.SQL,
    "op2_licenses": licenses.SQL,
    "op4_chat": chat.SQL,
    "op10_quality_rules": weak_rules.SQL,
    "op11_divergence": divergence.SQL,
    "op12_warc": warc.SQL,
    "op13_wavelet": wavelet.SQL,
}

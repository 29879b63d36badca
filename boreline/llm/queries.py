"""The query of each operator, with SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from boreline.llm import bpe, decontam, fingerprint, licenses, linededup, minhash, repair, resample, substring, tokenids, toxicity, urlfilter, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": bpe.op1_bpe,
    "op2_warc": warc.op2_warc,
    "op3_toxicity": toxicity.op3_toxicity,
    "op4_licenses": licenses.op4_licenses,
    "op5_minhash": minhash.op5_minhash,
    "op6_fingerprints": fingerprint.op6_fingerprints,
    "op7_substring": substring.op7_substring,
    "op8_decontamination": decontam.op8_decontamination,
    "op9_linededup": linededup.op9_linededup,
    "op10_urlfilter": urlfilter.op10_urlfilter,
    "op11_tokenids": tokenids.op11_tokenids,
    "op12_resample": resample.op12_resample,
    "op13_repair": repair.op13_repair,
}

ORACLE: dict[str, str] = {
    "op2_warc": warc.ORACLE,
    "op4_licenses": licenses.ORACLE,
    "op9_linededup": linededup.ORACLE,
    "op10_urlfilter": urlfilter.ORACLE,
    "op12_resample": resample.ORACLE,
    "op13_repair": repair.ORACLE,
}

"""The registered queries of this subpackage and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from strataflow.llm import bpe, hnsw, infill, katz, licenses, linededup, mixing, multiset, packing, periodicity, secrets, simhash, toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_katz": katz.op1_katz,
    "op2_secrets": secrets.op2_secrets,
    "op3_licenses": licenses.op3_licenses,
    "op4_toxicity": toxicity.op4_toxicity,
    "op5_bpe": bpe.op5_bpe,
    "op6_mixing": mixing.op6_mixing,
    "op7_multiset": multiset.op7_multiset,
    "op8_hnsw": hnsw.op8_hnsw,
    "op9_simhash": simhash.op9_simhash,
    "op10_line_dedup": linededup.op10_line_dedup,
    "op11_periodic_runs": periodicity.op11_periodic_runs,
    "op12_fill_in_middle": infill.op12_fill_in_middle,
    "op13_packing": packing.op13_packing,
}

#: Queries whose rows SQL can give on whole tables; the tests compare the others
#: with brute-force versions.
ORACLES: dict[str, str] = {
    "op3_licenses": licenses.SQL,
    "op6_mixing": mixing.SQL,
    "op7_multiset": multiset.SQL,
    "op10_line_dedup": linededup.SQL,
    "op12_fill_in_middle": infill.SQL,
}

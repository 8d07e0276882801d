"""The registered corpus queries and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidelog.llm import balltree, bpe, imatch, jaccard, language, licenses, lines, middle, mixing, pii, token_files, urlfilter, whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii": pii.op1_pii,
    "op2_token_files": token_files.op2_token_files,
    "op3_topk": balltree.op3_topk,
    "op4_url_filter": urlfilter.op4_url_filter,
    "op5_jaccard_join": jaccard.op5_jaccard_join,
    "op6_language": language.op6_language,
    "op7_bpe": bpe.op7_bpe,
    "op8_mixing": mixing.op8_mixing,
    "op9_licenses": licenses.op9_licenses,
    "op10_fingerprints": imatch.op10_fingerprints,
    "op11_whitening": whitening.op11_whitening,
    "op12_fill_in_middle": middle.op12_fill_in_middle,
    "op13_line_dedup": lines.op13_line_dedup,
}
# The others have no twin: models, vocabularies, connected components and hashes that the
# checking engine lacks. They are tested by brute force, round trip or held-out accuracy.
ORACLES = {
    "op3_topk": balltree.SQL, "op4_url_filter": urlfilter.SQL, "op8_mixing": mixing.SQL, "op9_licenses": licenses.SQL,
    "op12_fill_in_middle": middle.SQL, "op13_line_dedup": lines.SQL,
}

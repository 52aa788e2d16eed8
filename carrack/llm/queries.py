"""The registered queries of this package and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import centroids, langid, lines, mixing, packing, pieces, quotes, simhash, substrings, syncmers, trie, vectors, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": langid.op1_language_id,
    "op2_sentencepiece": pieces.op2_sentencepiece,
    "op3_line_dedup": lines.op3_line_dedup,
    "op4_simhash_near_dedup": simhash.op4_simhash_near_dedup,
    "op5_substring_dedup": substrings.op5_substring_dedup,
    "op6_embedding_near_dedup": vectors.op6_embedding_near_dedup,
    "op7_quotation_links": quotes.op7_quotation_links,
    "op8_best_fit_packing": packing.op8_best_fit_packing,
    "op9_syncmer_fingerprints": syncmers.op9_syncmer_fingerprints,
    "op10_warc_archives": warc.op10_warc_archives,
    "op11_mixing": mixing.op11_mixing,
    "op12_centroids": centroids.op12_centroids,
    "op13_prefix_trie": trie.op13_prefix_trie,
}
ORACLES: dict[str, str] = {
    "op3_line_dedup": lines.ORACLE,
    "op5_substring_dedup": substrings.ORACLE,
    "op6_embedding_near_dedup": vectors.ORACLE,
    "op7_quotation_links": quotes.ORACLE,
    "op10_warc_archives": warc.ORACLE,
    "op11_mixing": mixing.ORACLE,
    "op12_centroids": centroids.ORACLE,
    "op13_prefix_trie": trie.ORACLE,
}

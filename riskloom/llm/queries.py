"""Queries of this package and their SQL twins, for ``__spark_entry__``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from riskloom.llm import bpe, fingerprints, html_text, merkle, mixing, perplexity, quality_rules, repeats, sharding, simhash, spelling, token_counts, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc_index": warc.op1_warc_index,
    "op2_kneser_ney": perplexity.op2_kneser_ney,
    "op3_quality_rules": quality_rules.op3_quality_rules,
    "op4_fingerprints": fingerprints.op4_fingerprints,
    "op5_shard_table": sharding.op5_shard_table,
    "op6_source_mix": mixing.op6_source_mix,
    "op7_simhash": simhash.op7_simhash,
    "op8_suffix_dedup": repeats.op8_suffix_dedup,
    "op9_byte_bpe": bpe.op9_byte_bpe,
    "op10_token_counts": token_counts.op10_token_counts,
    "op11_spelling_variants": spelling.op11_spelling_variants,
    "op12_html_text": html_text.op12_html_text,
    "op13_merkle_manifest": merkle.op13_merkle_manifest,
    "pipeline": corpus_pipeline.run,
}

ORACLE: dict[str, str] = {
    "op1_warc_index": warc.OP1_SQL,
    "op3_quality_rules": quality_rules.op3_sql(),
    "op5_shard_table": sharding.op5_sql(),
    "op6_source_mix": mixing.OP6_SQL,
    "op11_spelling_variants": spelling.op11_sql(),
    "op13_merkle_manifest": merkle.op13_sql(),
}

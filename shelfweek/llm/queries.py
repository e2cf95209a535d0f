"""The operators as queries over the test tables, and SQL for those that SQL can express."""

from __future__ import annotations

import public_tokenizers

import corpus_pipeline
from shelfweek.llm import byte_tokens, cross_polytope, curriculum, dom_model, hilbert, lexical, line_frequency, merkle, oracle, packing, quotes, secret_scan, setsketch, url_rules
from shelfweek.llm.common import table

TOKENS = "byte_bpe_multi_50k.tiktoken"
WORD_TOKENS = "word_bpe_49k.json"


def op1_secret_scan(spark, root):
    return secret_scan.secret_report(table(spark, root, "documents"))


def op2_source_mix(spark, root):
    return curriculum.mix_report(table(spark, root, "documents"))


def op3_setsketch_dedup(spark, root):
    return setsketch.near_duplicates(table(spark, root, "documents"), width=2)


def op4_quote_linking(spark, root):
    return quotes.threaded(table(spark, root, "conversations"))


def op5_hilbert_shards(spark, root):
    return hilbert.shard_report(table(spark, root, "documents"))


def op6_line_frequency(spark, root):
    return line_frequency.line_rules(table(spark, root, "documents"))


def op7_cross_polytope(spark, root):
    return cross_polytope.linked_vectors(table(spark, root, "embeddings"))


def op8_dom_text(spark, root):
    return dom_model.extracted(table(spark, root, "pages"))


def op9_url_rules(spark, root):
    return url_rules.judged(table(spark, root, "pages"))


def op10_byte_tokens(spark, root):
    return byte_tokens.token_report(table(spark, root, "documents"), public_tokenizers.path(TOKENS), public_tokenizers.PATTERN)


def op11_lexical_search(spark, root):
    return lexical.top_documents(table(spark, root, "documents"), table(spark, root, "benchmark"))


def op12_merkle_manifest(spark, root):
    return merkle.verified(table(spark, root, "documents"))


def op13_best_fit_packing(spark, root):
    return packing.packed_pieces(table(spark, root, "documents"), public_tokenizers.path(WORD_TOKENS))


def pipeline(spark, root):
    return corpus_pipeline.run(spark, root)


QUERIES = {run.__name__: run for run in (
    op1_secret_scan, op2_source_mix, op3_setsketch_dedup, op4_quote_linking, op5_hilbert_shards, op6_line_frequency, op7_cross_polytope,
    op8_dom_text, op9_url_rules, op10_byte_tokens, op11_lexical_search, op12_merkle_manifest, op13_best_fit_packing, pipeline)}
ORACLE = {"op1_secret_scan": oracle.SECRETS, "op2_source_mix": oracle.MIX, "op6_line_frequency": oracle.LINES, "op9_url_rules": oracle.URLS,
          "op11_lexical_search": oracle.SEARCH, "op12_merkle_manifest": oracle.MANIFEST}
if corpus_pipeline.ORACLE_SQL:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL

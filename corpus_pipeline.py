"""From raw documents to token ids in five stages; each reads what the stage before it kept."""

from __future__ import annotations

import public_tokenizers

from shelfweek.llm import byte_tokens, curriculum, line_frequency, secret_scan, setsketch
from shelfweek.llm.common import staged, table

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
SHINGLE = 5


def quality_rules(spark, docs, sf_dir):
    """Documents that pass the line rules, without the lines that too many texts of their host share."""
    return line_frequency.clean_documents(docs)


def near_dedup(spark, docs, sf_dir):
    """One document of each group of near duplicates, by shingles of five words."""
    return setsketch.one_of_each(docs, width=SHINGLE)


def secret_scans(spark, docs, sf_dir):
    """All documents, with their secrets masked."""
    return secret_scan.masked(docs)


def source_mix(spark, docs, sf_dir):
    """The copies that the mix takes, in training order."""
    return curriculum.mixed(docs)


def token_ids(spark, docs, sf_dir):
    """Ids of every copy, with digests of the ids and of what they decode to."""
    keep = [c for c in ("doc_id", "lang", "source") if c in docs.columns]
    out = byte_tokens.token_rows(docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN, keep=keep)
    return out.select("row.*", "ids", "n_tokens", "ids_sha256", "decoded_sha256")


STAGES = [("quality_rules", quality_rules), ("near_dedup", near_dedup), ("secret_scans", secret_scans), ("source_mix", source_mix), ("token_ids", token_ids)]

# Similar sets and token ids are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over the documents, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

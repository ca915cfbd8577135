"""From raw documents to packed sequences: STAGES in order, each over all that its predecessor kept.

Every stage takes (spark, docs, sf_dir) and returns the columns of ``docs``
(the last: packed pieces). Nulls, empty texts and empty tables are handled as
the operators define; a stage drops rows only for its own reason.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagweave.llm import chunk_dedup, decontaminate, jaccard, langid, packing
from tagweave.llm.common import semi_join, table, written

#: Not SQL (byte trees, rolling hashes, packing); tested against brute force.
ORACLE_SQL = None
TOKENIZER = "word_bpe_49k.json"
#: A text that costs this many bits a byte under its best language is in none of them.
MAX_BITS_PER_BYTE = 8.0


def _without(docs: DataFrame, drop: DataFrame, label: str) -> DataFrame:
    key = drop.select(F.col("doc_id").cast(docs.schema["doc_id"].dataType).alias("doc_id")).distinct()
    return semi_join(docs, written(key, label), "doc_id", "left_anti")


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language (no letters, or compressed by no learned language) go."""
    found = langid.identify(docs)
    none = (F.col("lang_pred") == langid.UNKNOWN) | (F.col("bits_per_byte") >= MAX_BITS_PER_BYTE)
    return _without(docs, found.where(none), "pipeline-no-language")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays."""
    found = jaccard.jaccard_components(docs)
    return _without(docs, found.where("component_id <> doc_id"), "pipeline-copies")


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages are cut out of the texts; a document left without a word goes.

    n_chars, where there is one, is the new text's. Null texts stay null.
    """
    found = chunk_dedup.remove_repeats(docs)
    text = F.when(F.col("text").isNotNull(), F.col("_kept"))
    emptied = (F.col("_n_removed") > 0) & (F.trim(F.translate("_kept", "\t\n\u000b\f\r", "     ")) == "")
    new = {"text": text} | ({"n_chars": F.char_length(text).cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {})
    return found.where(~emptied).withColumns(new).select(docs.columns)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"))
    return _without(docs, found.where("contaminated"), "pipeline-contaminated")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The kept documents as pieces in sequences."""
    return packing.pack_documents(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("language_id", identify_language),
    ("ngram_jaccard_join", near_duplicates),
    ("substring_dedup", repeated_passages),
    ("benchmark_decontamination", decontaminated),
    ("best_fit_packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

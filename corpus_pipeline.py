"""Five stages from raw documents to token ids, each written as Parquet and read again.

Quality rules drop documents that fail, or whose host does; line dedup cuts later copies
of repeated runs of lines, and drops documents of which nothing is left; the n-gram
Jaccard join keeps the document of least id of each component; decontamination drops
documents that hold a benchmark item; the last stage encodes what is left. All but the
last return the columns of their input; an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import decontaminate, line_dedup, ngram_join, pieces, quality
from corpusloom.session import table, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs that pass the base rules and whose host passes all. A null or empty text fails;
    a null source is a host of its own; repeated rows stay each."""
    return quality.keep_documents(docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs with later copies of line runs cut, and n_chars counted anew where one was; a
    document of which no word is left goes, one that had none before stays."""
    cut = line_dedup.dedup_lines(docs, counted="__cut_lines")
    left = F.col("text").rlike(r"[^\x20\x09-\x0D]")
    kept = cut.where((F.col("__cut_lines") == 0) | left)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        kept = kept.withColumn("n_chars", F.when(F.col("__cut_lines") > 0, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return kept.select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of least id of each component. Repeated rows of one id and text are
    one document and stay; documents without an id go only for one that has one."""
    return ngram_join.one_of_each(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs that hold no benchmark item; a null or empty text or item matches nothing."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids, source and language of each document with its pieces; a null or empty text has
    none; repeated rows get equal ones."""
    return pieces.encode_documents(docs, pieces.public_model(), keys=("doc_id", "lang", "source"))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", dedup_lines),
    ("ngram_jaccard_join", near_duplicates),
    ("benchmark_decontamination", decontaminated),
    ("sentencepiece", encoded),
]

#: Near-copy components, edit distances and merges are not SQL. A test holds the whole
#: result, row for row, against a plain Python version of the five stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs

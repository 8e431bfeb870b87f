"""Corpus pipeline: stages over the documents table, each written as Parquet and reread as the next one's input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.llm import best_fit_packing, jaccard_join, line_dedup, quality_rules, source_mixing
from ledgerflow.llm.common import WORD, materialize, table


def _free_name(docs: DataFrame, name: str) -> str:
    """A column name that docs does not have; names differ by more than case."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go.

    A null or blank text is rejected; repeated rows are judged alike; an empty table stays empty; other columns,
    whatever their names, pass through.
    """
    return quality_rules.keep_good(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated and nearly repeated lines go, and so does a document that has no words left after that.

    The earliest line by (doc_id, place) stays, a null doc_id being last; rows that repeat a document keep the same
    lines; a null text stays as it is; an empty table stays empty; n_chars follows a text that lost lines; other
    columns pass through.
    """
    counts = _free_name(docs, "_lines_before"), _free_name(docs, "_lines_removed")
    done = line_dedup.dedup(docs, counts=counts)
    untouched = F.col(counts[1]) == 0
    done = done.filter(untouched | F.col("text").rlike(WORD))
    if "n_chars" in docs.columns:
        done = done.withColumn("n_chars", F.when(untouched, F.col("n_chars")).otherwise(F.length("text").cast("long")))
    return done.select([F.col(f"`{c}`") for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones stays: five-word shingles, four fifths of them shared.

    The smallest doc_id of a group stays, a null one being last; of rows that repeat a document one stays; a text
    without words, null or not, is similar to nothing and stays; an empty table stays empty; other columns pass through.
    """
    return jaccard_join.keep_one(docs, shingle=5, percent=80)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target weight asks for.

    A null source is the last one; a null text has no words and a source without words is not taken; repeated
    rows are documents of their own; an empty table stays empty; other columns pass through.
    """
    return source_mixing.emit(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens in sequences of fixed length: for each piece its ids and its place.

    A null text is empty and gives its closing id alone; repeated rows are packed each on its own; an empty table
    gives no pieces; other columns are not read.
    """
    return best_fit_packing.pack(docs, best_fit_packing.default_tokenizer(), with_ids=True)


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("n-gram Jaccard join", near_duplicates),
    ("mixing sources to target weights", mixing),
    ("best-fit packing", packing),
]

#: Tokenising cannot be said in SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs)
    return docs

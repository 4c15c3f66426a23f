"""Cleaning pipeline over ``documents``: a list of stages, each one operator of ``flightlens.llm``.

Every stage takes all that its predecessor kept and, but for the last, returns
the columns of ``documents``. Rows, columns and edge cases are defined by the
operators: rows with null text are unknown in language and go; other columns
pass through whatever their names.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flightlens.llm import language_id, line_dedup, packing, quality_rules, simhash
from flightlens.llm.common import read_table, stored


def _renamed(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with neutral column names, and the names by which to find its columns."""
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known by a clear margin."""
    rows, name = _renamed(docs)
    known = rows.where(~language_id.held_out(name["doc_id"]))
    dictionaries = language_id.learn(known, name["doc_id"], name["text"], name["lang"])
    judged = language_id.classify(rows, dictionaries, rows.columns, name["text"])
    return judged.where(~F.col("rejected")).select(*rows.columns).toDF(*docs.columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and resemble trusted text."""
    rows, name = _renamed(docs)
    fitted = quality_rules.fit(rows, read_table(spark, sf_dir, "labels"), name["doc_id"], name["text"])
    judged = quality_rules.judge(rows, *fitted, rows.columns, name["text"])
    return judged.where("kept").select(*rows.columns).toDF(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that match an earlier line."""
    rows, name = _renamed(docs)
    return line_dedup.remove_lines(rows, name["doc_id"], name["text"]).toDF(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    rows, name = _renamed(docs)
    return simhash.one_of_each(rows, 3, 3, name["doc_id"], name["text"]).toDF(*docs.columns)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The remaining documents packed into sequences of 4096 tokens."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1, capacity=4096)


STAGES = [
    ("language_id", language),
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("simhash_near_dedup", near_copies),
    ("best_fit_packing", sequences),
]

#: SQL has neither zstandard nor the tokenizer; the tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each result is written as Parquet and read again as the next one's input."""
    docs = read_table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stored(docs, f"stage-{k}-{name}")
    return docs

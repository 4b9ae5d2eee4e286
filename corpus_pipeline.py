"""Corpus pipeline: raw documents to packed training sequences.

Each stage takes what its predecessor kept, is written as Parquet and read again, and calls one operator of
``tidemark.llm``. All but the last return the columns of documents:

* quality: rows that a quality rule rejects go;
* exact_dedup: of equal texts (white space aside) one row stays, the longest, then the smallest id;
* near_dedup: of documents connected by Jaccard links of 0.8 over five-word shingles the smallest id stays;
* secrets: every secret found is replaced by a mark, no row goes;
* packing: the texts become pieces of sequences of 1,024 tokens, each window of them with the corpus's mixture of sources.

Null texts fail the quality rules; an empty table gives no pieces; additional columns are carried along, whatever their
names.

What a stage stages for itself stays until the next stage is called, by the same thread and on its written result.
"""

from __future__ import annotations

import threading
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.common import drop, read, reads_only_others, recorded, stage
from tidemark.llm.exact_dedup import keep_first
from tidemark.llm.jaccard_join import keep_one
from tidemark.llm.packing import pack
from tidemark.llm.quality import passing
from tidemark.llm.secret_scan import redact


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

_HELD = threading.local()


def frees_before(step: Stage) -> Stage:
    """``step`` that first deletes what the stages before it have staged, unless ``docs`` isn't written and still reads it."""

    @wraps(step)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        held = getattr(_HELD, "tables", [])
        if reads_only_others(docs, held):
            drop(*held)
            held = []
        _HELD.tables = held
        with recorded(held):
            return step(spark, docs, sf_dir)

    return run


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return passing(docs)


@frees_before
def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_first(docs)


@frees_before
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one(docs)


@frees_before
def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return redact(docs)


@frees_before
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("secrets", secrets),
    ("packing", packing),
]

#: The packing stage's ids come from a tokenizer, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        before, docs = docs, stage(step(spark, docs, sf_dir), f"pipeline_{name}")
        drop(before)
    return STAGES[-1][1](spark, docs, sf_dir)

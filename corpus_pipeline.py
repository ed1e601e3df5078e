"""Corpus pipeline: every stage takes the documents its predecessor kept, written as Parquet and read again.

A stage's result is to be written before the next stage is called: the tables that it worked with, and that
its result may still read, are deleted then.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidings.llm import best_fit_packing, minhash_forest, quality_rules, substring_dedup, toxicity_fm
from tidings.llm.common import Scope, Table, read

_left: list[tuple[SparkSession, Scope]] = []  # tables of the stage before


def _clear(spark: SparkSession) -> None:
    while _left:
        session, scope = _left.pop()
        if session is spark:
            scope.drop()


def _stage(work: Callable) -> Callable:
    @wraps(work)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        _clear(spark)
        with Scope() as scope:
            out = work(spark, docs, sf_dir)
        _left.append((spark, scope))
        return out

    return run


@_stage
def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality_rules.keep_good(docs)


@_stage
def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below one half; the model is fitted on the labelled ones among the given."""
    return toxicity_fm.drop_toxic(docs, read(spark, sf_dir, "labels"))


@_stage
def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five words, a similarity of 0.8."""
    return minhash_forest.keep_first(docs, percent=80)


@_stage
def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of 35 words or more that start anywhere else; ``n_chars`` follows the text."""
    out = substring_dedup.remove_repeats(docs)
    new = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType)
    return out.select(*[new.get(c, out["row"][c]).alias(c) for c in docs.columns])


@_stage
def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 token ids with their sequence and place."""
    return best_fit_packing.pack_documents(docs)


STAGES = [
    ("quality_rules", quality_stage),
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_duplicate_stage),
    ("substring_dedup", substring_stage),
    ("best_fit_packing", packing_stage),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = read(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        kept = Table(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if before is not None:
            before.drop()
        docs, before = kept.df(), kept
    _clear(spark)
    return docs

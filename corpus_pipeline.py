"""Corpus pipeline: toxicity, near-duplicates, secrets, mixing, encoding.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
each stage's result as Parquet to the shared scratch folder and hands what it
reads back to the next.  All stages but the last return the columns of
``documents``, in their order and with their types.  The toxicity stage trains a
model, which SQL cannot express, so there is no SQL for the whole; the tests hold it
against a plain version.

Defined results, of every stage: other columns are carried through untouched, also
those named like a column that an operator adds; repeated rows are rows of their own;
an empty table gives no rows; texts are taken whole, however long.  Of null ids,
null and blank texts each stage says its own.

Stages hand small batches to Python.  Spark reads that setting when a stage's rows are
computed, so a stage leaves it set; ``run``, which computes them, puts it back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwise.llm import jaccard, mixing, pieces, secrets, toxicity
from cartwise.llm.common import ship, table, written


#: Rows handed to Python at once, and parts of texts an encoding worker remembers:
#: workers live through all stages, so each stage keeps its memory small.
BATCH_ROWS, REMEMBERED = 2000, 80_000
BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: The columns that a stage's operator does not know, as one.
REST = "__pipeline_rest"


def _small_batches(spark: SparkSession) -> None:
    spark.conf.set(BATCH_SETTING, str(BATCH_ROWS))


def _needed(docs: DataFrame, *names: str) -> DataFrame:
    """The named columns, and all others as one struct that no operator touches."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in names]
    own = [F.col(c) for c in names if c in docs.columns]
    return docs.select(*own, *([F.struct(*rest).alias(REST)] if rest else []))


def _as(docs: DataFrame, *names: str) -> list[Column]:
    """The columns of ``docs`` from a frame made of :func:`_needed`."""
    return [F.col(c) if c in names else F.col(REST).getField(c).alias(c) for c in docs.columns]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go.  The model learns from the labelled rows of
    ``documents`` that are not held out, whatever ``docs`` still holds of them.
    A null, empty or blank text scores like one without words; an id plays no part."""
    _small_batches(spark)
    scored = toxicity.score(_needed(docs, "text"), toxicity.fitted(spark, sf_dir))
    return scored.where(F.col("predicted") == 0).select(*_as(docs, "text"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of documents linked by shingle similarity one stays, that of the
    smallest id, with its repeated rows.  Texts that are null or without words are
    linked with nothing and stay; so do rows without an id."""
    _small_batches(spark)
    return jaccard.deduplicated(_needed(docs, "doc_id", "text")).select(*_as(docs, "doc_id", "text"))


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret span is replaced by a mark, and ``n_chars`` then counts the new
    text; no document goes, and a text without secrets (null ones too) is unchanged."""
    own = ("text", "n_chars")
    return secrets.redact(_needed(docs, *own)).select(*_as(docs, *own))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeat, or go, as the target of their source asks; one document of a
    source is cut after its last word taken.  Null, empty and blank texts hold no words
    and go; a null source is a source, a null id is an id."""
    own = ("doc_id", "text", "source", "n_chars")
    return mixing.mixture(_needed(docs, *own)).select(*_as(docs, *own))


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text: doc_id, source, n_tokens, ids.  A null or empty text has none."""
    _small_batches(spark)
    return pieces.encode(docs.select("doc_id", "source", "text"), pieces.default_model(),
                         outputs=("n_tokens", "ids"), remembered=REMEMBERED).select("doc_id", "source", "n_tokens", "ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("near duplicates", drop_near_duplicates),
    ("secrets", hide_secrets),
    ("mix", mix_sources),
    ("encode", encode_texts),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    before = spark.conf.get(BATCH_SETTING)
    docs = table(spark, sf_dir, "documents")
    try:
        for name, stage in STAGES:
            docs = written(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    finally:
        spark.conf.set(BATCH_SETTING, before)
    return docs

"""Writers: tables (parquet / CSV) and model persistence."""

from __future__ import annotations

import logging

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

log = logging.getLogger(__name__)

# Quotes inside quoted fields are doubled, as most other CSV readers and writers do.
CSV = {"header": True, "quote": '"', "escape": '"'}


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: list[str] | None = None) -> None:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.options(**CSV).csv(path)
    else:
        w.format(fmt).save(path)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", schema=None) -> DataFrame:
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    if fmt == "csv":
        return r.options(**CSV).csv(path)
    return r.format(fmt).load(path)


def save_model(model: PipelineModel, path: str) -> bool:
    try:
        model.write().overwrite().save(path)
        return True
    except Exception as exc:  # reported, not raised (callers decide)
        log.warning("failed to save model to %s: %s", path, exc)
        return False


def load_model(path: str) -> PipelineModel | None:
    """The saved model, or None when it is missing or unreadable."""
    try:
        return PipelineModel.load(path)
    except Exception as exc:
        log.info("no model at %s: %s", path, exc)
        return None


def try_read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame | None:
    """The table, or None when it is missing or unreadable."""
    try:
        df = read_table(spark, path, fmt)
        df.schema  # noqa: B018  (forces file listing)
        return df
    except Exception as exc:
        log.info("no table at %s: %s", path, exc)
        return None

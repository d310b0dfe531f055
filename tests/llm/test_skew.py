"""Joins on hot keys can be split: the side of the aggregate is a written table."""

import pytest
from pyspark.sql import functions as F

from cartwise.llm import jaccard, warc, windows
from cartwise.llm.common import written

CONF = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}


@pytest.fixture
def splitting(spark):
    before = {k: spark.conf.get(k, None) for k in CONF}
    for k, v in CONF.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def plan_after(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def half_hot(spark, n, hot):
    """Every second row has one key."""
    key = F.when(F.col("id") % 2 == 0, F.lit(hot)).otherwise(F.concat(F.lit("k"), F.col("id").cast("string")))
    return spark.range(0, n, 1, 8).select("id", key.alias("key"))


def test_members_of_a_hot_hub(splitting):
    edges = written(half_hot(splitting, 20_000, "hub").select(
        F.concat(F.lit("a"), "id").alias("a"), F.col("key").alias("b")), "test-edges")
    dealt, salts = jaccard.salted(edges)
    assert "skew=true" in plan_after(dealt)
    assert salts.where("hub = 'hub'").first().salts == -(-10_000 // jaccard.HUB_MEMBERS)
    most = dealt.groupBy("b", "salt").count().agg(F.max("count")).first()[0]
    assert most < 2 * jaccard.HUB_MEMBERS


def test_nodes_of_a_large_component(splitting):
    rooted = written(half_hot(splitting, 20_000, "root").select(
        F.concat(F.lit("n"), "id").alias("k"), "id", F.col("key").alias("root")), "test-rooted")
    out = jaccard.component_ids(rooted)
    assert "skew=true" in plan_after(out)
    assert out.where("kk = 'n19998'").first().component_id == 0


def test_pages_of_one_common_body(splitting):
    large = written(half_hot(splitting, 20_000, "body").select("id", F.col("key").alias("digest")), "test-pages")
    out = warc.revisited(large)
    assert "skew=true" in plan_after(out)
    assert out.count() == 9_999 and out.agg(F.max("first")).first()[0] == 0


def test_the_sample_of_frequent_grams_is_bounded(spark, monkeypatch):
    """As many documents at any number of them."""


    docs = windows.keyed(spark.range(3000).select(
        F.col("id").alias("doc_id"), F.concat_ws(" ", *[F.lit("the same words")] * 10, F.col("id")).alias("text")),
        "doc_id", "text")
    seen = []
    real = type(docs).where

    def where(self, condition):
        out = real(self, condition)
        seen.append(out.count())
        return out

    monkeypatch.setattr(type(docs), "where", where)
    for wanted in (50, 500):
        seen.clear()
        grams = windows.frequent_grams(docs, jaccard.KIND, wanted, 0.5)
        assert len(grams) and wanted / 2 < seen[0] < 2 * wanted
    assert windows.SLOTS // 10 ** 15 > 100  # and at a million times a billion documents

"""The pipeline, stage by stage, against plain versions on a small folder."""

import re

import corpus_pipeline as cp
import sentencepiece
from cartwise.llm import mixing, pieces, toxicity
from cartwise.llm.common import word_count
from conftest import SF_SMALL
from pyspark.sql import functions as F

from .test_jaccard import classes
from .test_secrets import base


def test_stages(spark):
    names = [n for n, _ in cp.STAGES]
    assert len(names) == 5
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    stage = dict(cp.STAGES)
    model = toxicity.fitted(spark, SF_SMALL)
    toxic = {r.doc_id for r in toxicity.score(docs, model).where("predicted = 1").collect()}
    calm = stage["toxicity"](spark, docs, SF_SMALL).cache()
    assert calm.columns == docs.columns
    assert {r.doc_id for r in calm.collect()} == {r.doc_id for r in docs.collect()} - toxic

    single = stage["near duplicates"](spark, calm, SF_SMALL).cache()
    want = classes([(r.doc_id, r.text) for r in calm.collect()])
    assert sorted(r.doc_id for r in single.collect()) == sorted(i for i, (_, c) in want.items() if c == i)

    safe = stage["secrets"](spark, single, SF_SMALL).cache()
    before = {r.doc_id: r.text for r in single.collect()}
    for r in safe.collect():
        if base(before[r.doc_id])[1]:
            assert not base(r.text)[1] and "[SECRET]" in r.text
        else:
            assert re.sub(r"\[SECRET\]", "", r.text) == r.text or r.text != before[r.doc_id]

    mixed = stage["mix"](spark, safe, SF_SMALL).cache()
    assert mixed.columns == docs.columns
    taken = mixing.mix(safe).agg(F.sum("taken")).first()[0]
    assert mixed.agg(F.sum(word_count(F.col("text")))).first()[0] == taken

    ids = stage["encode"](spark, mixed, SF_SMALL).collect()
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())
    texts = sorted((r.doc_id, library.encode(r.text)) for r in mixed.collect())
    assert sorted((r.doc_id, r.ids) for r in ids) == texts


def test_run_gives_the_stages_in_turn(spark):
    out = cp.run(spark, SF_SMALL)
    assert out.columns == ["doc_id", "source", "n_tokens", "ids"] and out.count() > 0


# ---- defined results of each stage ---------------------------------------------------
CLASHING = ["score", "predicted", "toxic_spans", "n_shingles", "component_id", "found", "base_found", "size",
            "source_size", "target", "taken", "epochs", "part", "n_tokens", "ids", "k", "id", "with.dot"]
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars", *CLASHING]


def odd_docs(spark, extra=()):
    """Null ids and texts, blank, empty, repeated and very long ones; every other column
    named like something an operator adds, each cell different."""
    texts = [(1, "A first plain document with enough words to be one of its own kind."), (2, None), (3, ""),
             (4, " \n\t "), (None, "A text without any id that stays what it is, in all the stages here."),
             (None, None), (5, "Repeated row of some words that come twice in this very table."),
             (5, "Repeated row of some words that come twice in this very table."),
             (6, "see token=abcdef123 in this text of quite different words than the rest"),
             (7, "long " * 40_000 + "words end"), *extra]
    rows = [(i, t, "en" if n % 2 else None, ["s1", "s2", None][n % 3], None if t is None else len(t),
             *[f"{c}-{n}" for c in CLASHING]) for n, (i, t) in enumerate(texts)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(
        f"`{c}` string" for c in CLASHING)
    return spark.createDataFrame(rows, schema)


def cells(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_every_stage_on_an_empty_table(spark):
    docs = odd_docs(spark).limit(0)
    for name, stage in cp.STAGES:
        out = stage(spark, docs, SF_SMALL)
        assert out.count() == 0, name
        assert name == "encode" or (out.columns == COLUMNS and out.dtypes == docs.dtypes)


def test_toxicity_keeps_clean_rows_as_they_are(spark):
    sf = "/root/testdata/sf0.01"  # the smallest table has too few labels to learn from
    known = spark.read.parquet(f"{sf}/documents.parquet")
    toxic = toxicity.score(known, toxicity.fitted(spark, sf)).where("predicted = 1").first()
    docs = odd_docs(spark, [(8, toxic.text), (None, toxic.text)])
    out = cp.drop_toxic(spark, docs, sf)
    assert out.columns == COLUMNS and out.dtypes == docs.dtypes
    assert cells(out) == cells(docs.where(F.col("text").isNull() | (F.col("text") != toxic.text)))


def test_near_duplicates_keep_what_links_with_nothing(spark):
    one = "A first plain document with enough words to be one of its own kind."
    docs = odd_docs(spark, [(0, one), (9, one), (9, one)])
    out = cp.drop_near_duplicates(spark, docs, SF_SMALL)
    assert out.columns == COLUMNS and out.dtypes == docs.dtypes
    # 1 and both rows of 9 are copies of 0
    assert cells(out) == cells(docs.where("doc_id IS NULL OR doc_id NOT IN (1, 9)"))


def test_secrets_leave_other_texts_untouched(spark):
    docs = odd_docs(spark)
    out = cp.hide_secrets(spark, docs, SF_SMALL)
    assert out.columns == COLUMNS and out.dtypes == docs.dtypes
    other = F.col("doc_id").isNull() | (F.col("doc_id") != 6)
    assert cells(out.where(other)) == cells(docs.where(other))
    new, old = out.where("doc_id = 6").first(), docs.where("doc_id = 6").first()
    assert new.text == old.text.replace("token=abcdef123", "[SECRET]") and new.n_chars == len(new.text)
    assert [new[c] for c in CLASHING] == [old[c] for c in CLASHING]


def test_mix_repeats_whole_documents_and_cuts_one_of_a_source(spark):
    docs = odd_docs(spark, [(20 + i, f"words of document {i} " * (i + 1)) for i in range(12)])
    out = cp.mix_sources(spark, docs, SF_SMALL)
    assert out.columns == COLUMNS and out.dtypes == docs.dtypes
    taken = mixing.mix(docs.select("doc_id", "text", "source", F.col("score").alias("row"))).collect()
    of_row = {r.row: r for r in taken}
    copies, cut = {}, {}
    for r in out.collect():
        source = of_row[r.score]
        copies.setdefault(r.score, []).append(r)
        assert r.doc_id == source.doc_id and r.n_chars == len(r.text) and r.source == source.source
        assert len({r[c].removeprefix(c) for c in CLASHING}) == 1  # cells of one row
        if r.text != source.text:
            assert source.text.split()[:len(r.text.split())] == r.text.split()
            cut.setdefault(r.source, []).append(r)
    assert all(len(v) == 1 for v in cut.values())
    for row, r in of_row.items():
        mine = copies.get(row, [])
        assert sum(len(x.text.split()) for x in mine) == r.taken and len(mine) <= 2
        assert r["size"] or not mine


def test_encode_gives_no_ids_to_null_and_empty_texts(spark):
    docs = odd_docs(spark)
    got = cp.encode_texts(spark, docs, SF_SMALL)
    assert got.columns == ["doc_id", "source", "n_tokens", "ids"]
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())
    want = [(r.doc_id, r.source, len(ids := library.encode(r.text or "")), ids) for r in docs.collect()]
    assert cells(got) == sorted(want, key=repr)


def test_run_puts_the_session_back_and_goes_through_odd_tables(spark, tmp_path):
    setting = cp.BATCH_SETTING
    before = spark.conf.get(setting)
    odd_docs(spark).write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{SF_SMALL}/labels.parquet").limit(0).write.parquet(str(tmp_path / "labels.parquet"))
    spark.conf.set(setting, "777")
    try:
        out = cp.run(spark, str(tmp_path))
        assert spark.conf.get(setting) == "777" and out.count() > 0
    finally:
        spark.conf.set(setting, before)

"""Nulls in any column, empty and very long texts, repeats, empty tables and clashing names, through every stage and query."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from plumbline.llm.common import stored

CLASHES = "y int, part int, row long, block int, score double, key string, id long, rank int, n long, hash long, component_id long, item_id long, spans string, ids string, lang_pred string, held_out string"
WIDE = "doc_id long, text string, lang string, source string, n_chars long, " + CLASHES
LONG = "word and more " * 20_000 + "token = 0123456789abcdef0123456789abcdef"


def documents(spark):
    texts = [None, "", " \n", "one two three four five six", LONG, LONG, "Ünï cödé " * 30, "a", "%%% " * 40, "you idiot moron scum " * 5]
    rows = [(i % 17 if i % 11 else None, texts[i % len(texts)], "en" if i % 3 else None, None if i % 4 else "s", i if i % 5 else None) for i in range(40)]
    return spark.createDataFrame([(*r, *[None] * 16) for r in rows], WIDE)


def tables(spark, folder, empty):
    docs = documents(spark)
    vectors = [(i if i % 9 else None, [float(i % 7), 1.0, float(i % 3)] if i % 7 else None, i) for i in range(60)]
    made = {
        "documents": docs,
        "labels": spark.createDataFrame([(i if i % 7 else None, i % 2 if i % 5 else None, (i // 2) % 2) for i in range(17)], "doc_id long, quality int, toxic int"),
        "benchmark": spark.createDataFrame([(1, "one two three four five six", "x"), (None, "a", None), (2, None, "y"), (1, "one two three four five six", "z")], "item_id long, text string, doc_id string"),
        "pages": spark.createDataFrame([(i if i % 4 else None, None if i % 3 == 0 else f"http://a{i % 2}.com/en/", None if i % 5 == 0 else "h" * (99 + i % 3), "x") for i in range(30)], "page_id long, url string, html string, digest string"),
        "embeddings": spark.createDataFrame(vectors, "vec_id long, embedding array<float>, label int"),
    }
    for name, df in made.items():
        (df.limit(0) if empty else df).write.parquet(f"{folder}/{name}.parquet")
    return f"file://{folder}"


@pytest.mark.parametrize("empty", [False, True])
def test_every_query(spark, tmp_path, empty):
    sf_dir = tables(spark, tmp_path / "t", empty)
    many = {"documents": 40, "pages": 30}
    for name, q in entry.queries().items():
        if name.startswith("op"):
            out = q(spark, sf_dir)
            n = out.count()
            if empty:
                assert n == 0, name
            elif name.startswith(("op3", "op4", "op5", "op8", "op9", "op10")):
                assert n == many["documents"], name
            elif name.startswith(("op1_", "op7")):
                assert n == many["pages"], name
            else:
                assert n > 0, name


@pytest.mark.parametrize("empty", [False, True])
def test_every_stage(spark, tmp_path, empty):
    sf_dir = tables(spark, tmp_path / "t", empty)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(spark, stage(spark, docs, sf_dir), name)
        assert name == "bpe" or docs.columns == columns
        assert docs.count() <= before
        before = docs.count()
    assert empty or (before > 0 and docs.filter(F.col("ids").isNull()).count() == 0)

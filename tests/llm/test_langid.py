"""Language ID: held-out accuracy, sparsity, calibration, and edge cases."""

import numpy as np
from pyspark.sql import functions as F

import __spark_entry__ as entry
from conftest import SF_MID, SF_SMALL
from ridgeway.llm import langid


def test_held_out_accuracy_and_calibration(spark):
    got = entry.queries()["op8_language_id"](spark, SF_MID).toPandas()
    truth = spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "lang").toPandas()
    both = got.merge(truth, on="doc_id")
    held = both[both.held_out]
    assert len(both) == len(truth) and 100 < len(held) < 300
    right = held.lang_pred == held.lang
    assert right.mean() > 0.97
    assert held.score.between(0, 1).all()
    assert abs(held.score.mean() - right.mean()) < 0.05


def test_weights_are_sparse(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    model = langid.fit(docs)
    assert sorted(model.labels) == model.labels == sorted({r.lang for r in docs.select("lang").distinct().collect()})
    assert 0 < model.stats["nonzero"] < 0.5 * langid.SIZE * len(model.labels)


def test_counts_do_not_depend_on_the_step():
    text = "Ça va, ÉTÉ!  tout -- va bien; x" * 50
    a, b = langid.ngram_counts(text), langid.ngram_counts(text, step=7)
    assert np.array_equal(a[0], b[0]) and np.array_equal(a[1], b[1])


def test_sample_is_fixed_and_takes_copies_one_by_one(spark):
    rows = [(i, "the one and the other", "en") for i in range(600)] + [(i, f"der eine und das andere {i}", "de") for i in range(600, 900)]
    rows += [(900 + i, f"le premier et un autre {i}", "fr") for i in range(10)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    fits = [langid.fit(df.repartition(n, "doc_id"), rows_per_label=30, id_col="doc_id") for n in (1, 7)]
    a, b = fits
    assert a.labels == ["de", "en", "fr"] and a.stats == b.stats and a.temperature == b.temperature
    assert np.array_equal(a.weights, b.weights) and np.array_equal(a.bias, b.bias)
    assert 40 < a.stats["fit_rows"] + a.stats["calibration_rows"] < 110  # neither none of the copies nor all 600
    repeated = df.unionByName(df.where("doc_id = 1").withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(500)))).drop("n"))
    got = langid.fit(repeated, rows_per_label=30, id_col="doc_id").stats
    assert got["fit_rows"] + got["calibration_rows"] < 110


def test_edge_cases(spark):
    rows = [(i, "the one and the other " * (i % 3 + 1), "en") for i in range(40)]
    rows += [(i, "der eine und das andere " * (i % 3 + 1), "de") for i in range(40, 80)]
    rows += [(100, None, "en"), (101, "", "de"), (102, "123 !!", None), (103, "the " * 400_000, None), (None, "und das", None)]
    rows += [(3, "the one and the other ", "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    wide = df.selectExpr("*", "1 AS score", "'a' AS label", "2 AS lang_pred")
    got = langid.fit_and_predict(wide).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert [by[k].lang_pred for k in (100, 101, 102)] == ["und"] * 3 and by[100].score == 0
    assert by[103].lang_pred == "en" and by[None].lang_pred == "de" and by[None].held_out
    assert by[7].lang_pred == "en" and by[50].lang_pred == "de"
    assert langid.fit_and_predict(df.limit(0)).collect() == []
    assert {r.lang_pred for r in langid.fit_and_predict(df.withColumn("lang", df.lang.substr(5, 0)).replace("", None, "lang")).collect()} == {"und"}

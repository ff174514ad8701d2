"""Quality classifier: held-out accuracy, gradients, slice-wise scoring, and edge cases."""

import numpy as np
import pytest

import __spark_entry__ as entry
from conftest import SF_MID
from ridgeway.llm import quality


def auc(score, label):
    rank = np.argsort(np.argsort(score, kind="stable"), kind="stable") + 1
    pos = label == 1
    return (rank[pos].sum() - pos.sum() * (pos.sum() + 1) / 2) / (pos.sum() * (~pos).sum())


def test_held_out_accuracy(spark):
    got = entry.queries()["op2_quality_classifier"](spark, SF_MID).toPandas()
    assert len(got) == spark.read.parquet(f"{SF_MID}/documents.parquet").count() and got.score.between(0, 1).all()
    assert ((got.score >= 0.3).astype(int) == got.predicted).all()
    both = got.merge(spark.read.parquet(f"{SF_MID}/labels.parquet").toPandas(), on="doc_id")
    held = both[both.held_out]
    assert len(held) > 40 and held.quality.nunique() == 2
    assert auc(held.score.to_numpy(), held.quality.to_numpy()) > 0.95
    assert (held.predicted == held.quality).mean() > 0.95


def test_attention_finds_the_telling_passage():
    rng = np.random.default_rng(1)
    bags, labels = [], []
    for i in range(300):
        b = rng.normal(0, 0.02, (int(rng.integers(1, 9)), quality.FEATURES))
        b[:, 0] = 0
        if i % 2:
            b[rng.integers(len(b)), 0] = 1
        bags.append(b)
        labels.append(i % 2)
    model = quality.fit_bags(bags[:200], labels[:200], np.ones(200), epochs=60)
    right = top = 0
    for b, y in zip(bags[200:], labels[200:]):
        h, logit = model.encode(b)
        a = np.exp(logit - logit.max())
        right += (model.score((a / a.sum()) @ h) > 0.5) == y
        top += y and logit.argmax() == b[:, 0].argmax()
    assert right > 85 and top > 40


def test_slices_give_the_whole_texts_score(monkeypatch):
    rng = np.random.default_rng(0)
    bags = [rng.normal(0, 1, (3, quality.FEATURES)) for _ in range(20)]
    model = quality.fit_bags(bags, rng.integers(0, 2, 20), np.ones(20), epochs=2)
    words = [f"w{i % 17}!" if i % 5 else f"Word{i}" for i in range(64 * 40)]
    text = " ".join(words)
    whole = quality.score_texts(model, [text, None, "x"])
    size = len(" ".join(words[: 64 * 10]))
    pieces = [(" ".join(words[i : i + 640])).encode() for i in range(0, len(words), 640)]
    monkeypatch.setattr(quality, "_pieces", lambda t, s=0: iter(pieces) if t == text else iter([(t or "").encode()]))
    assert size and np.allclose(quality.score_texts(model, [text, None, "x"]), whole, atol=2e-3)


def test_features():
    x, piece = quality.passage_features([b"a a a b", b"", b" \n", ("word " * 130).encode()])
    assert piece.tolist() == [0, 1, 2, 3, 3, 3] and x.shape == (6, quality.FEATURES)
    stat = x[:, quality.KINDS**2 :]
    assert stat[0, 2] == pytest.approx(0.5) and stat[0, 3] == pytest.approx(0.5) and stat[5, 0] == pytest.approx(2 / 64)
    assert stat[:, -1].tolist() == [0, 1, 1, 0, 0, 0]


def test_sampled_passages_are_bounded_and_in_order():
    x = np.arange(1000, dtype=np.float32)[:, None] * np.ones((1, quality.FEATURES), np.float32)
    got = quality.sample_passages((x[i : i + 90] for i in range(0, 1000, 90)), 64, -5)
    assert got.shape == (64, quality.FEATURES) and (np.diff(got[:, 0]) > 0).all()
    assert np.array_equal(got, quality.sample_passages((x[i : i + 30] for i in range(0, 1000, 30)), 64, -5))
    assert np.array_equal(quality.sample_passages(iter([x[:50], x[50:64]]), 64, 1), x[:64])
    mean = np.mean([quality.sample_passages(iter([x]), 64, s)[:, 0].mean() for s in range(60)])
    assert abs(mean - 499.5) < 25


def test_fit_takes_a_bounded_part_of_very_long_and_repeated_texts(spark, monkeypatch):
    seen = {}
    monkeypatch.setattr(quality, "fit_bags", lambda bags, labels, weights: seen.update(bags=bags, labels=labels))
    rows = [(1, "a word of it. " * 60_000), (2, "JUNK!! " * 300)] + [(3, "short one. ")] * 200
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    marks = spark.createDataFrame([(1, 1), (2, 0), (3, 1)], "doc_id long, quality int")
    held = {r.id for r in marks.selectExpr("doc_id AS id").where(quality.held_out("id")).collect()}
    quality.fit(docs, marks, passages_per_doc=16)
    sizes = {1: 16, 2: 5, 3: 1}
    assert sorted(len(b) for b in seen["bags"]) == sorted(n for k, n in sizes.items() if k not in held)


def test_edge_cases(spark):
    good, bad = "a fine sentence of many words. ", "JUNK!! BUY!! NOW!! "
    rows = [(i, good * (i % 4 + 1)) for i in range(60)] + [(i, bad * (i % 4 + 1)) for i in range(60, 120)]
    labels = [(i, int(i < 60)) for i in range(120)] + [(3, None), (500, 1), (4, 1)]
    rows += [(200, None), (201, ""), (202, good * 60_000), (None, bad), (5, good)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS label", "'q' AS quality", "2 AS id", "3 AS score")
    marks = spark.createDataFrame(labels, "doc_id long, quality int").selectExpr("*", "'t' AS text")
    got = quality.predict(docs, quality.fit(docs, marks)).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    by = {r.doc_id: r for r in got}
    assert by[202].predicted == 1 and by[None].predicted == 0 and by[None].held_out and by[1].predicted == 1 and by[70].predicted == 0
    assert quality.fit(docs, marks.limit(0)) is None and quality.fit(docs.limit(0), marks) is None
    assert {r.score for r in quality.predict(docs, None).collect()} == {0.5}
    assert quality.predict(docs.limit(0), None).collect() == []

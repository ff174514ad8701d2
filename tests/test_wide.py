"""Every operator over margins at widths of 201, 2,000 and 10,000 against NumPy: vector points, and wide ones up to 2,000."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ridgeway.functions.losses import CustomLoss, get_loss
from ridgeway.operators import evaluate, line_search, loss_grad, svm
from ridgeway.operators.penalties import L2Penalty
from ridgeway.sources import points as pt

N = 12


WIDE_TESTS = ("test_predict_and_classify", "test_line_search")  # planning thousands of columns takes seconds a query


@pytest.fixture(params=[(201, "vector"), (201, "wide"), (2000, "vector"), (2000, "wide"), (10_000, "vector")], ids=lambda p: f"{p[1]}{p[0]}")
def case(request, spark):
    d, form = request.param
    if form == "wide" and d > 201 and request.function.__name__ not in WIDE_TESTS:
        pytest.skip("vector points cover this width")
    rng = np.random.default_rng(d)
    X = rng.standard_normal((N, d)) / np.sqrt(d)
    y = np.where(np.arange(N) % 3 == 0, 1.0, -1.0)
    df = spark.createDataFrame([(i, [float(v) for v in X[i]], float(y[i]), 0.25 + i / 40) for i in range(N)], "id long, v array<double>, y double, a double")
    points = pt.points_from_vectors(df, "v", "y", d, id="id")
    if form == "wide":
        points = points.wide()
    points = points.with_df(points.df.withColumn("a", 0.25 + F.col("id") / 40).coalesce(2))
    return points, X, y, rng.standard_normal(d)


def by_id(df, column):
    return np.array([r[column] for r in df.orderBy("id").select(column).collect()])


def test_predict_and_classify(case):
    points, X, y, w = case
    np.testing.assert_allclose(by_id(evaluate.predict_linear(points, w), "prediction"), X @ w, atol=1e-10)
    got = svm.classify(points, w)
    np.testing.assert_allclose(by_id(got, "margin"), X @ w, atol=1e-10)
    assert by_id(got, "prediction").tolist() == np.where(X @ w >= 0, 1.0, -1.0).tolist()


@pytest.mark.parametrize("name", ["logistic", "hinge", "squared"])
def test_pointwise(case, name):
    points, X, y, w = case
    rows = loss_grad.pointwise_frame(points, name, w, keep=["id"])
    loss, d = get_loss(name).numpy((X @ w)[:, None], y)
    np.testing.assert_allclose(by_id(rows, "loss"), loss, atol=1e-10)
    if points.vector:
        grad = by_id(rows, "g_0")
    else:
        j = [1, 57, points.d]
        grad = np.array([[r[f"g_0_{k}"] for k in j] for r in rows.orderBy("id").select("id", *(f"g_0_{k}" for k in j)).collect()])
        X = X[:, np.array(j) - 1]
    np.testing.assert_allclose(grad, d * X, atol=1e-10)


def test_softmax(case):
    points, X, y, w = case
    W = np.stack([w, -w, 0.5 * w])
    import dataclasses

    three = dataclasses.replace(points.with_df(points.df.withColumn("label", (F.col("id") % 3).cast("int"))), n_classes=3)
    rows = loss_grad.pointwise_frame(three, "softmax", W, keep=["id"])
    loss, _ = get_loss("softmax").numpy(X @ W.T, np.arange(N) % 3)
    np.testing.assert_allclose(by_id(rows, "loss"), loss, atol=1e-10)


def test_kernel_product_and_dual(case):
    points, X, y, w = case
    a = 0.25 + np.arange(N) / 40
    v = X.T @ (a * y)
    np.testing.assert_allclose(by_id(svm.signed_kernel_product(points), "ka"), y * (X @ v), atol=1e-10)
    rows = svm.dual_objective_grad(points, 2.0)
    np.testing.assert_allclose(by_id(rows, "grad"), y * (X @ v) / 4.0 - 1.0, atol=1e-10)
    np.testing.assert_allclose(by_id(rows, "objective"), a.sum() - v @ v / 8.0, atol=1e-10)
    back = svm.dual_to_weights(points.df.select("id", "a"), points, 2.0).orderBy("feature_id").collect()
    np.testing.assert_allclose([r.weight for r in back], v / 4.0, atol=1e-10)


def test_line_search(case):
    points, X, y, w = case
    got = line_search.line_search_table(points, "logistic", w, L2Penalty(), 0.1, eta0=40.0, candidates=12).orderBy("m").collect()
    loss = lambda u: np.logaddexp(0, -y * (X @ u)).mean() + 0.1 * L2Penalty().score(u)
    g = X.T @ (-y / (1 + np.exp(y * (X @ w)))) / N + 0.1 * L2Penalty().grad(w)
    want = [loss(w - 40.0 * 0.9**m * g) for m in range(12)]
    np.testing.assert_allclose([r.objective for r in got], want, rtol=1e-9)
    fine = [f <= loss(w) - 0.3 * 40.0 * 0.9**m * (g @ g) for m, f in enumerate(want)]
    assert [r.armijo for r in got] == fine and [r.chosen for r in got] == [m == fine.index(True) if True in fine else False for m in range(12)]


def test_custom_loss_in_columns_only(case):
    points, X, y, w = case
    cubic = CustomLoss("cubic", lambda z, t: (F.abs(z - t) * (z - t) * (z - t), 3.0 * F.abs(z - t) * (z - t)))
    r = (X @ w) - y
    if points.d > 2000:
        return
    if points.d > 201:  # the gradient takes one aggregate per 96 sums: the loss alone here
        wide = points.wide()
        got = loss_grad.loss_grad_row(wide, cubic, w, with_grad=False).first()
        assert got["loss"] == pytest.approx((np.abs(r) ** 3).sum())
        return
    with loss_grad.SparkEvaluator(points, cubic) as ev:
        n, loss, G = ev.evaluate(w)
    assert (n, loss) == (N, pytest.approx((np.abs(r) ** 3).sum()))
    np.testing.assert_allclose(G[0], (3 * np.abs(r) * r) @ X, rtol=1e-8)


def test_row_builders(case):
    points, X, y, w = case
    more = pt.append_bias(points)
    np.testing.assert_allclose(by_id(evaluate.predict_linear(more, np.r_[w, 2.0]), "prediction"), X @ w + 2.0, atol=1e-10)
    few = pt.slice_features(points, 7)
    np.testing.assert_allclose(by_id(evaluate.predict_linear(few, w[:7]), "prediction"), X[:, :7] @ w[:7], atol=1e-10)
    told = pt.respond_by_weights(points, w, F.lit(1.0), 0.5)
    np.testing.assert_allclose(by_id(told.df, "label"), X @ w + 0.5, atol=1e-10)


def test_wrong_length(case):
    points, _, _, w = case
    with pytest.raises(ValueError):
        evaluate.predict_linear(points, w[:-1])

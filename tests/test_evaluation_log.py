"""Fits that are stopped and started again: same trace, no repeated jobs, foreign tables refused."""

import numpy as np
import pytest

from ridgeway import fit
from ridgeway.operators import loss_grad as lg
from ridgeway.operators.evaluation_log import LoggedEvaluator, read_evaluations
from ridgeway.operators.penalties import BoxProjector, L1Penalty, L2Penalty
from ridgeway.sources import points as pt

D = 6


class Stopped(Exception):
    pass


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(3)
    X = rng.standard_normal((300, D)) / np.sqrt(1 + np.arange(D))
    y = np.where(X @ rng.standard_normal(D) + 0.3 * rng.standard_normal(300) > 0, 1.0, -1.0)
    rows = [(i, X[i].tolist(), float(y[i])) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, v array<double>, y double").repartition(3, "id")
    return pt.points_from_vectors(df, "v", "y", D, id="id")


def stop_after(monkeypatch, calls):
    """The evaluator raises after ``calls`` calls, as a lost driver would end the fit."""
    answer = LoggedEvaluator._answer

    def run(self, *args):
        if self.calls == calls:
            raise Stopped
        return answer(self, *args)

    monkeypatch.setattr(LoggedEvaluator, "_answer", run)


@pytest.mark.parametrize(
    "solver, kind, extra",
    [
        ("gradient_descent", L2Penalty, {}),
        ("bfgs", L2Penalty, {"memory": 3}),
        ("proximal", L1Penalty, {"lr": 2.0}),
        ("accelerated_proximal", L1Penalty, {"lr": 2.0, "lr_decay": False}),
        ("projected", None, {"projector": BoxProjector(-0.3, 0.3), "lr": 2.0}),
    ],
)
def test_a_stopped_fit_resumes_with_the_same_trace(spark, points, tmp_path, monkeypatch, solver, kind, extra):
    args = dict(loss="logistic", penalty=kind and kind(), lam=0.01 if kind else 0.0, solver=solver, n_iter=14, **extra)
    whole = fit(points, **args)
    path = str(tmp_path / "evaluations")
    with monkeypatch.context() as m:
        stop_after(m, 7)
        with pytest.raises(Stopped):
            fit(points, resume_path=path, write_every=3, **args)
    stored = read_evaluations(spark, path)
    assert {r.seq for r in stored.select("seq").distinct().collect()} == set(range(7))
    got = fit(points, resume_path=path, write_every=3, **args)
    assert got.status == whole.status and got.iterations == whole.iterations > 7 and got.jobs <= whole.jobs - 7
    assert np.allclose(got.path, whole.path, rtol=1e-9, atol=1e-12) and np.allclose(got.train_log, whole.train_log, rtol=1e-12)
    again = fit(points, resume_path=path, **args)
    assert again.jobs == 0 and np.array_equal(again.path, got.path)
    with pytest.raises(ValueError, match="another fit"):
        fit(points, init=np.full(D, 0.5), resume_path=path, **args)


def test_a_lost_flush_costs_only_its_calls(spark, points, tmp_path):
    path = str(tmp_path / "evaluations")
    weights = [np.full((1, D), 0.1 * k) for k in range(5)]
    first = LoggedEvaluator(lg.SparkEvaluator(points, "logistic"), spark, path, every=2)
    want = [first.evaluate(w) for w in weights]  # the fifth answer is held when the driver is lost
    first.inner.close()
    second = LoggedEvaluator(lg.SparkEvaluator(points, "logistic"), spark, path, every=2)
    got = [second.evaluate(w) for w in weights]
    assert second.replayed == 4 and second.jobs == 1
    for a, b in zip(got, want):
        assert a[0] == b[0] and a[1] == pytest.approx(b[1], rel=1e-12) and np.allclose(a[2], b[2], rtol=1e-9)
    n, losses, none = second.evaluate_many(weights[:3], with_grad=False)
    assert n == 300 and np.allclose(losses, [w[1] for w in want[:3]])
    second.close()
    third = LoggedEvaluator(lg.SparkEvaluator(points, "logistic"), spark, path)
    assert [third.evaluate(w)[1] for w in weights] == [g[1] for g in got]
    n, losses, grads = third.evaluate_many(weights[:3], with_grad=False)
    assert third.jobs == 0 and grads is None and len(losses) == 3
    third.close()
    assert read_evaluations(spark, str(tmp_path / "none")).count() == 0
    with pytest.raises(ValueError, match="every"):
        LoggedEvaluator(first.inner, spark, path, every=0)

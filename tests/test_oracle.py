"""Every catalogue query against its DuckDB oracle on the smallest tables."""

import math
import re

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from ridgeway.plans import catalog

QUERIES = catalog.QUERIES
SQL = catalog.ORACLE

# Scale rules every plan must keep: no cross products or nested-loop joins, and no
# row-at-a-time Python UDFs (Arrow batches via MapInArrow are allowed).
FORBIDDEN = re.compile(r"CartesianProduct|BroadcastNestedLoopJoin|BatchEvalPython")


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    if hasattr(v, "item"):
        return _norm(v.item())
    return repr(v)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


def _duck(duck, name):
    res = duck.execute(SQL[name])
    cols = [c[0] for c in res.description]
    return [dict(zip(cols, r)) for r in res.fetchall()]


def test_fixtures_reach_every_branch(duck):
    """Each of these answers has rows on both sides of the rule that its query tests."""
    hinge = _duck(duck, "pointwise_hinge")
    assert {r["loss"] > 0 for r in hinge} == {True, False}
    assert 0 < len(_duck(duck, "active_margin_filter")) < len(hinge)
    assert {r["armijo"] for r in _duck(duck, "batched_line_search")} == {True, False}
    assert {r["inside"] for r in _duck(duck, "box_membership")} == {True, False}
    for name in ("lambda_path", "lambda_path_logistic", "custom_loss_bowl_lasso", "fit_group_lasso", "l1_prox", "group_l1_prox"):
        assert {r["weight"] == 0 for r in _duck(duck, name)} == {True, False}, name
    boxed = [r["weight"] for r in _duck(duck, "fit_projected_gradient")]
    assert min(boxed) == -0.35 < max(boxed)
    for name in ("fit_proximal_gradient", "fit_accelerated_proximal", "fit_projected_gradient", "fit_multiclass_logistic_l2", "fit_group_lasso",
                 "fit_group_lasso_sqrt_threshold", "fit_group_lasso_wide", "fit_softmax_wide"):
        assert {r["status"] for r in _duck(duck, name)} == {"converged"}, name


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    rows = df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not FORBIDDEN.search(plan), f"{name}: {FORBIDDEN.search(plan).group(0)} in the plan"
    res = duck.execute(SQL[name])
    dcols = [c[0] for c in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    order = sorted(dcols)
    si = [df.columns.index(c) for c in order]
    di = [dcols.index(c) for c in order]
    got = sorted(tuple(_norm(r[i]) for i in si) for r in rows)
    want = sorted(tuple(_norm(r[i]) for i in di) for r in drows)
    assert len(got) == len(want)
    assert got == want


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["model_id", "class_id", "feature_id", "weight", "iterations", "status"]
    rows = df.collect()
    assert len(rows) == 4 and {r.status for r in rows} == {"converged"}

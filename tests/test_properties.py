"""Property tests: prox operators solve their problems; the two faces of each penalty agree."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SF_SMALL
from ridgeway.operators import penalties as pe
from ridgeway.sources.coefficients import embedding_coefficients

vec = st.lists(st.floats(-5, 5, allow_nan=False), min_size=4, max_size=4).map(np.array)
step = st.floats(0.0, 3.0, allow_nan=False)


@settings(max_examples=200, deadline=None)
@given(vec, step)
def test_l1_prox_minimises(v, t):
    p = pe.L1Penalty().prox(v, t)
    f = lambda x: t * np.abs(x).sum() + 0.5 * ((x - v) ** 2).sum()
    rng = np.random.default_rng(0)
    for _ in range(20):
        assert f(p) <= f(p + rng.normal(scale=0.1, size=4)) + 1e-12


@settings(max_examples=200, deadline=None)
@given(vec, step)
def test_group_prox_minimises(v, t):
    groups = [[0, 1], [2]]
    p = pe.GroupL1Penalty(groups).prox(v, t)
    f = lambda x: t * sum(np.linalg.norm(x[g]) for g in groups) + 0.5 * ((x - v) ** 2).sum()
    rng = np.random.default_rng(1)
    for _ in range(20):
        assert f(p) <= f(p + rng.normal(scale=0.1, size=4)) + 1e-10
    assert p[3] == v[3]  # a feature in no group is copied


@settings(max_examples=100, deadline=None)
@given(vec, step)
def test_l2_prox_minimises(v, t):
    p = pe.L2Penalty().prox(v, t)
    np.testing.assert_allclose(t * p + (p - v), 0.0, atol=1e-12)


def _by_model(rows, col="weight"):
    out = {}
    for r in rows:
        out.setdefault(r["model_id"], {})[r["feature_id"]] = r[col]
    return {m: np.array([f[k] for k in sorted(f)]) for m, f in out.items()}


@pytest.mark.parametrize("threshold", ["exact", "sqrt_size"])
def test_table_operators_agree_with_driver_penalties(spark, threshold):
    coef = embedding_coefficients(spark, SF_SMALL).where(F.col("model_id") < 25)
    groups = [list(range(8 * g + 1, 8 * g + 9)) for g in range(6)]
    gdf = pe.groups_frame(spark, groups)
    W = _by_model(coef.collect())
    l1 = _by_model(pe.l1_prox(coef, 0.1).collect())
    grp = _by_model(pe.group_l1_prox(coef, gdf, 0.2, threshold).collect())
    box = _by_model(pe.box_projection(coef).collect())
    gsc = {r["model_id"]: r["score"] for r in pe.group_l1_score(coef, gdf).collect()}
    l2s = {r["model_id"]: r["score"] for r in pe.l2_score(coef).collect()}
    inside = {r["model_id"]: r["inside"] for r in pe.box_membership(coef).collect()}
    drv_groups = [[j - 1 for j in g] for g in groups]
    for m, w in W.items():
        np.testing.assert_allclose(l1[m], pe.L1Penalty().prox(w, 0.1), atol=1e-12)
        np.testing.assert_allclose(grp[m], pe.GroupL1Penalty(drv_groups, threshold).prox(w, 0.2), atol=1e-12)
        np.testing.assert_allclose(box[m], pe.BoxProjector().project(w), atol=0)
        assert gsc[m] == pytest.approx(pe.GroupL1Penalty(drv_groups).score(w), rel=1e-12)
        assert l2s[m] == pytest.approx(pe.L2Penalty().score(w), rel=1e-12)
        assert inside[m] == pe.BoxProjector().contains(w)


def test_group_prox_with_a_hot_group(spark):
    rng = np.random.default_rng(7)
    hot = [(0, 0, j + 1, float(v)) for j, v in enumerate(rng.normal(scale=0.01, size=20_000))]
    small = [(m, 0, j + 1, float(rng.normal(scale=0.3))) for m in range(1, 1001) for j in range(8)]
    coef = spark.createDataFrame(hot + small, "model_id bigint, class_id int, feature_id int, weight double")
    groups = {**{j + 1: 1 for j in range(20_000)}}  # model 0: one group of 20k; models 1..: features 1..8 in it too
    gdf = pe.groups_frame(spark, groups)
    out = _by_model(pe.group_l1_prox(coef, gdf, 0.5).collect())
    w_hot = np.array([r[3] for r in hot])
    np.testing.assert_allclose(out[0], pe.GroupL1Penalty([list(range(20_000))]).prox(w_hot, 0.5), atol=1e-12)
    for m in (1, 500, 1000):
        w = np.array([r[3] for r in small if r[0] == m])
        np.testing.assert_allclose(out[m], pe.GroupL1Penalty([list(range(8))]).prox(w, 0.5), atol=1e-12)


def test_row_form_matches_long_form_without_a_shuffle(spark):
    from ridgeway.operators import row_penalties as rp
    from ridgeway.sources.tables import table

    groups = [list(range(8 * g + 1, 8 * g + 9)) for g in range(6)]
    rows = rp.coefficient_rows(table(spark, SF_SMALL, "embeddings"), "vec_id", "embedding")
    long = embedding_coefficients(spark, SF_SMALL)
    gdf = pe.groups_frame(spark, groups)
    assert rows.d == 64
    pairs = [
        (rp.l2_score_rows(rows), pe.l2_score(long), "score"),
        (rp.l1_score_rows(rows), pe.l1_score(long), "score"),
        (rp.group_l1_score_rows(rows, groups), pe.group_l1_score(long, gdf), "score"),
    ]
    for a, b, col in pairs:
        plan = a._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Generate" not in plan
        got = {r["model_id"]: r[col] for r in a.collect()}
        want = {r["model_id"]: r[col] for r in b.collect()}
        assert got.keys() == want.keys()
        for k in got:
            assert got[k] == pytest.approx(want[k], rel=1e-12)
    prox_rows = rp.group_l1_prox_rows(rows, groups, 0.2, "sqrt_size")
    assert "Exchange" not in prox_rows.df._jdf.queryExecution().executedPlan().toString()
    prox = _by_model(rp.to_long(prox_rows).collect())
    ref = _by_model(pe.group_l1_prox(long, gdf, 0.2, "sqrt_size").collect())
    for m in ref:
        np.testing.assert_allclose(prox[m], ref[m], atol=1e-12)


def test_row_form_rejects_ragged_arrays(spark):
    from ridgeway.operators import row_penalties as rp

    df = spark.createDataFrame([(1, [0.1, 0.2]), (2, [0.3])], "id bigint, w array<double>")
    rows = rp.coefficient_rows(df, "id", "w", d=2)
    with pytest.raises(Exception, match="must hold 2 weights"):
        rp.l2_score_rows(rows).collect()

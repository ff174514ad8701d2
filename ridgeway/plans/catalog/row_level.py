"""Point tables, labelling rules and pointwise losses."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...functions.losses import linear_margin
from ...operators import loss_grad as lg
from ...sources import fixtures as fx
from ...sources.points import append_bias as ab
from ...sources.points import argmax_label as am
from ...sources.points import encode_binary_label as eb
from ...sources.points import held_out_split as hos
from ...sources.points import respond_by_weights as rbw
from ...sources.points import slice_features as sl
from ...sources.tables import table
from .. import oracle as o
from .. import params as P
from .registry import QUERIES, register, rounded

# --- A1-A5, B1-B4, B6-B12: row-level operators ----------------------------------------------

def _rows(name: str, digits: int = 6):
    def run(spark, sf_dir):
        pts = fx.FIXTURES[name](spark, sf_dir)
        return rounded(pts.df.select(*pts.columns()), digits)
    return run


def _rows_sql(name: str, d: int, id_: bool = False) -> str:
    cols = (["id"] if id_ else []) + [o.R(f"x{j + 1}") + f" AS x{j + 1}" for j in range(d)]
    return f"SELECT {', '.join(cols)}, label FROM ({fx.duck_sql(name)})"


def _rows_sql_dbl(name: str, d: int, id_: bool = False) -> str:
    cols = (["id"] if id_ else []) + [o.R(f"x{j + 1}") + f" AS x{j + 1}" for j in range(d)]
    return f"SELECT {', '.join(cols)}, {o.R('label')} AS label FROM ({fx.duck_sql(name)})"


register("points_binary", _rows_sql_dbl("BIN", 4))(_rows("BIN"))
register("points_multiclass", _rows_sql("MULTI", 4))(_rows("MULTI"))
register("points_regression", _rows_sql_dbl("REG", 4))(_rows("REG"))
register("label_linear_threshold", _rows_sql_dbl("RBIN", 4))(_rows("RBIN"))
register("label_argmax_rule", _rows_sql("RMULTI", 2))(_rows("RMULTI"))
QUERIES["points_binary"].__doc__ = "A1: BIN labelled points from lineitem."
QUERIES["points_multiclass"].__doc__ = "A1: MULTI labelled points from lineitem (class 0..2 by return flag)."
QUERIES["points_regression"].__doc__ = "A1: REG labelled points from lineitem (three features, bias, scaled price)."
QUERIES["label_linear_threshold"].__doc__ = "A2: ±1 labels by the noisy linear rule (RBIN)."
QUERIES["label_argmax_rule"].__doc__ = "A3: class labels by the argmax of three noisy scores (RMULTI)."

A4_W = (2.0, -1.0, 1.5, 0.5) * 4 + (0.0,) * 32 + (-0.5, 1.0) * 8 + (0.3,)
A4_SCALE = 0.5


@register(
    "respond_by_weights",
    f"SELECT id, {o.R(f'{fx._duck_linear(A4_W, [f"x{j + 1}" for j in range(65)])} + ({o.D(A4_SCALE)} * (((id * 7) % 13) / 13 - 0.5))')} "
    f"AS label FROM ({fx.duck_sql('GRP')})",
)
def respond_by_weights(spark, sf_dir):
    """A4: y = X̃w + 0.5ε for a group-sparse w on the GRP rows."""
    pts = fx.grp_points(spark, sf_dir)
    eps = ((F.col("id") * 7) % 13) / 13 - 0.5
    out = rbw(pts, A4_W, eps, A4_SCALE)
    return rounded(out.df.select("id", "label"))


@register(
    "held_out_split",
    f"SELECT id, CASE WHEN id % 5 = 0 THEN 'test' ELSE 'train' END AS split FROM ({fx.duck_sql('GRP')})",
)
def held_out_split(spark, sf_dir):
    """A5: deterministic test/train tag of every GRP row (fold 0 of 5 is test)."""
    return hos(fx.grp_points(spark, sf_dir)).select("id", "split")


@register(
    "append_bias",
    f"SELECT id, {', '.join(o.R(f'x{j + 1}') + f' AS x{j + 1}' for j in range(64))}, {o.D(1)} AS x65, label "
    f"FROM ({fx.duck_sql('SVM')})",
)
def append_bias(spark, sf_dir):
    """B1: SVM points with a constant-1 feature appended."""
    pts = ab(fx.svm_points(spark, sf_dir))
    return rounded(pts.df.select(F.col("id"), *pts.features, "label"))


@register("slice_features", f"SELECT id, {o.R('x1')} AS x1, {o.R('x2')} AS x2, label FROM ({fx.duck_sql('SVM')})")
def slice_features(spark, sf_dir):
    """B2: SVM points restricted to their first two features."""
    pts = sl(fx.svm_points(spark, sf_dir), 2)
    return rounded(pts.df.select(F.col("id"), *pts.features, "label"))


@register(
    "encode_binary_label",
    f"SELECT l_returnflag, CASE WHEN l_returnflag = 'R' THEN {o.D(1)} ELSE {o.D(-1)} END AS label FROM lineitem",
)
def encode_binary_label(spark, sf_dir):
    """±1 encoding of the return flag on every lineitem row."""
    li = table(spark, sf_dir, "lineitem")
    return li.select("l_returnflag", eb(F.col("l_returnflag") == "R").alias("label"))


_WM = P.w_multi()


@register(
    "argmax_label",
    "SELECT "
    + ", ".join(f"{o.R(f'x{j + 1}')} AS x{j + 1}" for j in range(4))
    + ", label, CAST(list_position(list_value("
    + ", ".join(o.margin(_WM[c], o.feats_of(4)) for c in range(3))
    + "), list_max(list_value("
    + ", ".join(o.margin(_WM[c], o.feats_of(4)) for c in range(3))
    + "))) - 1 AS INTEGER) AS predicted FROM ("
    + fx.duck_sql("MULTI")
    + ")",
)
def argmax_label(spark, sf_dir):
    """Predicted class = first argmax of the three class margins under W_MULTI."""
    pts = fx.multi_points(spark, sf_dir)
    z = [linear_margin(_WM[c], list(pts.features)) for c in range(3)]
    return rounded(pts.df.select(*pts.features, "label", am(z).alias("predicted")))


def _pointwise_sql(fixture, loss, W, d):
    feats = o.feats_of(d)
    C = len(W)
    z = [o.margin(W[c], feats) for c in range(C)]
    l, dl = o.pointwise(loss, [f"margin_{c}" for c in range(C)], "label")
    inner = f"SELECT *, {', '.join(f'{z[c]} AS margin_{c}' for c in range(C))} FROM ({fx.duck_sql(fixture)})"
    lab = o.R("label") if loss != "softmax" else "label"
    grads = ", ".join(o.R(f"{dl[c]} * x{j + 1}") + f" AS g_{c}_{j + 1}" for c in range(C) for j in range(d))
    margins = ", ".join(o.R(f"margin_{c}") + f" AS margin_{c}" for c in range(C))
    return f"SELECT {lab} AS label, {margins}, {o.R(l)} AS loss, {grads} FROM ({inner})"


def _pointwise_query(fixture, loss, W):
    def run(spark, sf_dir):
        pts = fx.FIXTURES[fixture](spark, sf_dir)
        return rounded(lg.pointwise_frame(pts, loss, W))
    run.__doc__ = f"pointwise {loss} loss, margin and gradient per {fixture} row"
    return run


for _qn, (_fix, _loss, _W, _d) in {
    "pointwise_logistic": ("BIN", "logistic", [list(P.W_BIN)], 4),
    "pointwise_hinge": ("BIN", "hinge", [list(P.W_HINGE)], 4),
    "pointwise_softmax": ("MULTI", "softmax", P.w_multi(), 4),
    "pointwise_squared": ("REG", "squared", [list(P.W_REG)], 4),
}.items():
    register(_qn, _pointwise_sql(_fix, _loss, _W, _d))(_pointwise_query(_fix, _loss, _W))


@register(
    "linear_margin",
    f"SELECT {o.R('label')} AS label, {o.R(o.margin(P.W_BIN, o.feats_of(4)))} AS margin FROM ({fx.duck_sql('BIN')})",
)
def linear_margin_query(spark, sf_dir):
    """x·w per BIN row under W_BIN."""
    pts = fx.bin_points(spark, sf_dir)
    return rounded(pts.df.select("label", linear_margin(P.W_BIN, list(pts.features)).alias("margin")))


@register(
    "active_margin_filter",
    f"SELECT {', '.join(o.R(f'x{j + 1}') + f' AS x{j + 1}' for j in range(4))}, {o.R('label')} AS label, "
    f"{o.R('label * ' + o.margin(P.W_HINGE, o.feats_of(4)))} AS ymargin FROM ({fx.duck_sql('BIN')}) "
    f"WHERE label * {o.margin(P.W_HINGE, o.feats_of(4))} < 1",
)
def active_margin_filter(spark, sf_dir):
    """BIN rows whose hinge loss is positive (y·x·w < 1) under W_HINGE."""
    pts = fx.bin_points(spark, sf_dir)
    ym = F.col("label") * linear_margin(P.W_HINGE, list(pts.features))
    return rounded(pts.df.select(*pts.features, "label", ym.alias("ymargin")).where(F.col("ymargin") < 1))

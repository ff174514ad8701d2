"""Named point tables over the driver's test tables.

Each fixture is built with the library's own point builders (A1-A4) from a
whole table; ``duck_sql`` gives the same rows as a DuckDB query for the
oracle. Divisions are on doubles in both dialects.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .points import (
    PointSet,
    append_bias,
    encode_binary_label,
    label_argmax_rule,
    label_linear_threshold,
    points_from_array,
    points_from_columns,
    points_from_vectors,
)
from .tables import table

# Fixed values of the labelling rules (RBIN rule A2, RMULTI rule A3).
RBIN_COEFS = (2.0, -1.0)
RBIN_INTERCEPT = -0.5
RBIN_NOISE_SCALE = 0.5
RMULTI_W = ((2.0, -1.0, 0.5), (-3.0, 2.0, 1.0), (1.0, 2.0, 3.0))
RMULTI_NOISE_SCALE = 0.5


def _c(name: str):
    return F.col(name)


def _lineitem_x(spark: SparkSession, sf_dir: str):
    li = table(spark, sf_dir, "lineitem")
    return li, {
        "q": _c("l_quantity") / 50,
        "p": _c("l_extendedprice") / 100000,
        "disc": _c("l_discount") * 10,
        "tax": _c("l_tax") * 10,
    }


def bin_points(spark: SparkSession, sf_dir: str) -> PointSet:
    """BIN: four lineitem features, +1 for returned lines."""
    li, x = _lineitem_x(spark, sf_dir)
    return points_from_columns(li, [x["q"], x["p"], x["disc"], x["tax"]], encode_binary_label(_c("l_returnflag") == "R"))


def bin2_points(spark: SparkSession, sf_dir: str) -> PointSet:
    """BIN2: BIN restricted to quantity and discount."""
    li, x = _lineitem_x(spark, sf_dir)
    return points_from_columns(li, [x["q"], x["disc"]], encode_binary_label(_c("l_returnflag") == "R"))


def _eps(c: int = 1, modulus: int = 100):
    return ((_c("l_partkey") * c) % modulus) / modulus - 0.5


def rbin_points(spark: SparkSession, sf_dir: str) -> PointSet:
    """RBIN: BIN features, label from the noisy linear rule (A2)."""
    li, x = _lineitem_x(spark, sf_dir)
    feats = [x["q"], x["p"], x["disc"], x["tax"]]
    label = label_linear_threshold(RBIN_COEFS, feats[:2], RBIN_INTERCEPT, _eps(), RBIN_NOISE_SCALE)
    return points_from_columns(li, feats, label)


def multi_points(spark: SparkSession, sf_dir: str) -> PointSet:
    """MULTI: BIN features, class index A=0, N=1, R=2."""
    li, x = _lineitem_x(spark, sf_dir)
    label = F.when(_c("l_returnflag") == "A", 0).when(_c("l_returnflag") == "N", 1).otherwise(2)
    return points_from_columns(li, [x["q"], x["p"], x["disc"], x["tax"]], label, n_classes=3)


def rmulti_points(spark: SparkSession, sf_dir: str) -> PointSet:
    """RMULTI: two centred features, class from the argmax rule (A3)."""
    li, x = _lineitem_x(spark, sf_dir)
    u = (x["q"] - 0.5) * 3
    v = (x["p"] - 0.5) * 3
    noises = [((_c("l_partkey") * (c + 1)) % 101) / 101 - 0.5 for c in range(3)]
    label = label_argmax_rule(RMULTI_W, [u, v, F.lit(1.0)], noises, RMULTI_NOISE_SCALE)
    return points_from_columns(li, [u, v], label, n_classes=3)


def reg_points(spark: SparkSession, sf_dir: str) -> PointSet:
    """REG: three lineitem features plus a bias; target is the scaled price."""
    li, x = _lineitem_x(spark, sf_dir)
    pts = points_from_columns(li, [x["q"], x["disc"], x["tax"]], x["p"])
    return append_bias(pts)


def reg2_points(spark: SparkSession, sf_dir: str) -> PointSet:
    """REG2: quantity and discount against the scaled price."""
    li, x = _lineitem_x(spark, sf_dir)
    return points_from_columns(li, [x["q"], x["disc"]], x["p"])


EMBEDDING = 64


def svm_points(spark: SparkSession, sf_dir: str) -> PointSet:
    """SVM: all embedding elements, +1 for labels below 5."""
    em = table(spark, sf_dir, "embeddings")
    return points_from_array(em, "embedding", encode_binary_label(_c("label") < 5), EMBEDDING, id="vec_id")


def grp_points(spark: SparkSession, sf_dir: str) -> PointSet:
    """GRP: all embedding elements plus a bias; real label."""
    em = table(spark, sf_dir, "embeddings")
    return append_bias(points_from_array(em, "embedding", _c("label").cast("double"), EMBEDDING, id="vec_id"))


def sm10_points(spark: SparkSession, sf_dir: str) -> PointSet:
    """SM10: all embedding elements as one vector column, ten classes."""
    em = table(spark, sf_dir, "embeddings")
    return points_from_vectors(em, "embedding", _c("label"), EMBEDDING, id="vec_id", n_classes=10)


FIXTURES = {
    "BIN": bin_points,
    "BIN2": bin2_points,
    "RBIN": rbin_points,
    "MULTI": multi_points,
    "RMULTI": rmulti_points,
    "REG": reg_points,
    "REG2": reg2_points,
    "SVM": svm_points,
    "GRP": grp_points,
    "SM10": sm10_points,
}


# --- DuckDB forms of the same rows ----------------------------------------------------

_D1 = "CAST(1 AS DOUBLE)"


def _duck_bin_x() -> dict[str, str]:
    return {
        "q": "l_quantity / 50",
        "p": "l_extendedprice / 100000",
        "disc": "l_discount * 10",
        "tax": "l_tax * 10",
    }


def _lit(v: float) -> str:
    return f"CAST({float(v)!r} AS DOUBLE)"


def _duck_linear(coefs, inputs, intercept=0.0) -> str:
    acc = None
    for c, x in zip(coefs, inputs):
        term = f"({_lit(c)} * ({x}))"
        acc = term if acc is None else f"({acc} + {term})"
    if intercept:
        acc = f"({acc} + {_lit(intercept)})"
    return acc


def duck_sql(name: str) -> str:
    """SELECT producing the fixture's rows (columns: [id,] x1..xd, label)."""
    x = _duck_bin_x()
    sign = f"CASE WHEN l_returnflag = 'R' THEN {_D1} ELSE -{_D1} END"
    if name == "BIN":
        return f"SELECT {x['q']} AS x1, {x['p']} AS x2, {x['disc']} AS x3, {x['tax']} AS x4, {sign} AS label FROM lineitem"
    if name == "BIN2":
        return f"SELECT {x['q']} AS x1, {x['disc']} AS x2, {sign} AS label FROM lineitem"
    if name == "RBIN":
        eps = "((l_partkey * 1) % 100) / 100 - 0.5"
        score = f"({_duck_linear(RBIN_COEFS, [x['q'], x['p']], RBIN_INTERCEPT)} + ({_lit(RBIN_NOISE_SCALE)} * ({eps})))"
        lab = f"CASE WHEN {score} > 0 THEN {_D1} ELSE -{_D1} END"
        return f"SELECT {x['q']} AS x1, {x['p']} AS x2, {x['disc']} AS x3, {x['tax']} AS x4, {lab} AS label FROM lineitem"
    if name == "MULTI":
        lab = "CASE WHEN l_returnflag = 'A' THEN 0 WHEN l_returnflag = 'N' THEN 1 ELSE 2 END"
        return f"SELECT {x['q']} AS x1, {x['p']} AS x2, {x['disc']} AS x3, {x['tax']} AS x4, {lab} AS label FROM lineitem"
    if name == "RMULTI":
        u = f"(({x['q']}) - 0.5) * 3"
        v = f"(({x['p']}) - 0.5) * 3"
        scores = []
        for c, w in enumerate(RMULTI_W):
            eps = f"((l_partkey * {c + 1}) % 101) / 101 - 0.5"
            scores.append(f"({_duck_linear(w, [u, v, _D1])} + ({_lit(RMULTI_NOISE_SCALE)} * ({eps})))")
        arr = f"list_value({', '.join(scores)})"
        lab = f"CAST(list_position({arr}, list_max({arr})) - 1 AS INTEGER)"
        return f"SELECT {u} AS x1, {v} AS x2, {lab} AS label FROM lineitem"
    if name == "REG":
        return (
            f"SELECT {x['q']} AS x1, {x['disc']} AS x2, {x['tax']} AS x3, {_D1} AS x4, "
            f"{x['p']} AS label FROM lineitem"
        )
    if name == "REG2":
        return f"SELECT {x['q']} AS x1, {x['disc']} AS x2, {x['p']} AS label FROM lineitem"
    feats = ", ".join(f"CAST(embedding[{j + 1}] AS DOUBLE) AS x{j + 1}" for j in range(EMBEDDING))
    if name == "SVM":
        return f"SELECT vec_id AS id, {feats}, CASE WHEN label < 5 THEN {_D1} ELSE -{_D1} END AS label FROM embeddings"
    if name == "GRP_TRAIN":
        return f"SELECT * FROM ({duck_sql('GRP')}) WHERE id % 5 <> 0"
    if name == "GRP":
        return f"SELECT vec_id AS id, {feats}, {_D1} AS x{EMBEDDING + 1}, CAST(label AS DOUBLE) AS label FROM embeddings"
    if name == "SM10":
        return f"SELECT vec_id AS id, {feats}, label FROM embeddings"
    raise KeyError(name)

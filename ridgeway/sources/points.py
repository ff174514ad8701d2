"""Labelled-point tables (A1) and the row-level builders around them.

A point table is an ordinary DataFrame with one double column per feature
(``x1 .. xd``), a label column and, where the source has one, a unique row
id. Wide double columns keep every loss and gradient expression inside
whole-stage codegen; the Arrow paths read the same columns as a matrix.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.losses import linear_margin, vector_margin


@dataclass(frozen=True)
class PointSet:
    """A DataFrame plus the names of its feature, label and id columns."""

    df: DataFrame
    features: tuple[str, ...]
    label: str = "label"
    id: str | None = None
    n_classes: int | None = None  # set for class-index labels
    vector: str | None = None  # one array<double> column that holds all features, in the order of their names

    @property
    def d(self) -> int:
        return len(self.features)

    def feature_columns(self) -> list[str]:
        return [self.vector] if self.vector else list(self.features)

    def columns(self) -> list[str]:
        return ([self.id] if self.id else []) + self.feature_columns() + [self.label]

    def wide(self) -> "PointSet":
        """The same points with one column per feature."""
        if not self.vector:
            return self
        cols = [F.col(self.vector)[j].alias(x) for j, x in enumerate(self.features)]
        df = self.df.select(*([self.id] if self.id else []), *cols, self.label)
        return replace(self, df=df, vector=None)

    def projected(self) -> "PointSet":
        """Only the columns a fit needs (column pruning reaches the scan)."""
        return replace(self, df=self.df.select(*self.columns()))

    def persist(self) -> "PointSet":
        """Project and cache for an iterative job, which scans this table once per step."""
        return replace(self, df=self.projected().df.persist(StorageLevel.MEMORY_AND_DISK))

    def unpersist(self) -> None:
        self.df.unpersist()

    def with_df(self, df: DataFrame) -> "PointSet":
        return replace(self, df=df)


def _all_of(conditions: Sequence[Column]) -> Column:
    """Conjunction as a balanced tree, so that thousands of terms stay shallow."""
    level = list(conditions)
    while len(level) > 1:
        level = [level[i] & level[i + 1] if i + 1 < len(level) else level[i] for i in range(0, len(level), 2)]
    return level[0]


def _usable(name: str, floating: bool = True) -> Column:
    c = F.col(name)
    return c.isNotNull() & ~F.isnan(c) if floating else c.isNotNull()


def _keep_usable(df: DataFrame, usable: Column, bad: str) -> DataFrame:
    if bad == "drop":
        return df.where(usable)
    if bad == "fail":
        return df.where(F.when(usable, True).otherwise(F.raise_error(F.lit("null or NaN feature or label")).cast("boolean")))
    raise ValueError("bad must be 'drop' or 'fail'")


def points_from_columns(
    df: DataFrame,
    features: Sequence[Column] | dict[str, Column],
    label: Column,
    id: Column | str | None = None,
    n_classes: int | None = None,
    bad: str = "drop",
) -> PointSet:
    """A1: build a point table from aligned feature and label expressions.

    Rows with a null or NaN feature or label carry no meaning for a labelled
    point: they are dropped (``count_unusable`` tells how many), or with
    ``bad='fail'`` the job fails. The null test is pushed to the Parquet scan.
    """
    if isinstance(features, dict):
        named = [c.cast("double").alias(n) for n, c in features.items()]
        names = tuple(features.keys())
    else:
        names = tuple(f"x{j + 1}" for j in range(len(features)))
        named = [c.cast("double").alias(n) for c, n in zip(features, names)]
    cols: list[Column] = []
    id_name = None
    if id is not None:
        id_col = F.col(id) if isinstance(id, str) else id
        id_name = "id"
        cols.append(id_col.cast("bigint").alias("id"))
    label_col = label.cast("int" if n_classes else "double").alias("label")
    out = df.select(*cols, *named, label_col)
    usable = _all_of([_usable("label", not n_classes), *(_usable(n) for n in names)])
    return PointSet(_keep_usable(out, usable, bad), names, "label", id_name, n_classes)


def count_unusable(df: DataFrame, features: Sequence[Column], label: Column) -> DataFrame:
    """One row (rows, unusable): how many rows ``points_from_columns`` drops for a null or NaN."""
    named = [c.cast("double").alias(f"x{j + 1}") for j, c in enumerate(features)]
    out = df.select(*named, label.cast("double").alias("label"))
    usable = _all_of([_usable(c) for c in out.columns])
    return out.agg(F.count(F.lit(1)).alias("rows"), F.count(F.when(~usable, 1)).alias("unusable"))


def _vector_source(df: DataFrame, features: str) -> Column:
    src = F.col(features)
    dtype = df.schema[features].dataType
    if dtype.typeName() == "vector" or type(dtype).__name__ == "VectorUDT":
        from pyspark.ml.functions import vector_to_array

        src = vector_to_array(src)
    return src


def _exact_length(src: Column, d: int) -> Column:
    return F.when(src.isNull() | (F.size(src) == d), src).otherwise(
        F.raise_error(F.lit(f"feature vector not of length {d}")).cast("array<double>")
    )


def points_from_array(
    df: DataFrame,
    features: str,
    label: Column | str,
    d: int,
    id: Column | str | None = None,
    n_classes: int | None = None,
    bad: str = "drop",
) -> PointSet:
    """A1 for a vector column: ``array<float|double>`` or a Spark ML vector.

    Element j becomes the double column ``x{j+1}`` (d is fixed when the job is
    built), so the wide, codegen-friendly aggregates apply unchanged. A vector
    of any other length than d fails the job; a null one, or one with a null or
    NaN element, is an unusable row (see ``points_from_columns``).
    """
    return points_from_vectors(df, features, label, d, id, n_classes, bad).wide()


def points_from_vectors(
    df: DataFrame,
    features: str,
    label: Column | str,
    d: int,
    id: Column | str | None = None,
    n_classes: int | None = None,
    bad: str = "drop",
) -> PointSet:
    """A1 for wide vectors: the features stay one ``array<double>`` column, whatever d.

    The rules are those of ``points_from_array``; losses and moments are then
    summed by the Arrow strategy.
    """
    lab = F.col(label) if isinstance(label, str) else label
    cols = []
    if id is not None:
        cols.append((F.col(id) if isinstance(id, str) else id).cast("bigint").alias("id"))
    vec = _exact_length(_vector_source(df, features), d).cast("array<double>")
    out = df.select(*cols, vec.alias("features"), lab.cast("int" if n_classes else "double").alias("label"))
    fine = F.col("features").isNotNull() & ~F.exists("features", lambda v: v.isNull() | F.isnan(v))
    usable = fine & _usable("label", not n_classes)
    names = tuple(f"x{j + 1}" for j in range(d))
    return PointSet(_keep_usable(out, usable, bad), names, "label", "id" if cols else None, n_classes, "features")


# --- A2 / A3 / B3 / B4: labelling rules --------------------------------------------


def encode_binary_label(predicate: Column) -> Column:
    """+1.0 where the predicate holds, else -1.0."""
    return F.when(predicate, F.lit(1.0)).otherwise(F.lit(-1.0))


def linear_score(coefs: Sequence[float], inputs: Sequence[Column], intercept: float = 0.0) -> Column:
    """Left-to-right sum of coef * input (+ intercept): a linear score per row."""
    acc: Column | None = None
    for c, x in zip(coefs, inputs):
        term = F.lit(float(c)) * x
        acc = term if acc is None else acc + term
    if intercept:
        acc = acc + F.lit(float(intercept))
    return acc


def label_linear_threshold(
    coefs: Sequence[float], inputs: Sequence[Column], intercept: float, noise: Column, noise_scale: float
) -> Column:
    """A2: ±1 label by the sign of a noisy linear score (score + scale*noise > 0)."""
    return encode_binary_label(linear_score(coefs, inputs, intercept) + F.lit(float(noise_scale)) * noise > 0)


def argmax_label(scores: Sequence[Column]) -> Column:
    """0-based index of the largest score; the first maximum wins."""
    arr = F.array(*scores)
    return (F.array_position(arr, F.array_max(arr)) - 1).cast("int")


def label_argmax_rule(
    weight_rows: Sequence[Sequence[float]], inputs: Sequence[Column], noises: Sequence[Column], noise_scale: float
) -> Column:
    """A3: class = argmax_c W_c . inputs + scale * noise_c."""
    scores = [
        linear_score(w, inputs) + F.lit(float(noise_scale)) * e for w, e in zip(weight_rows, noises)
    ]
    return argmax_label(scores)


# --- B1 / B2: feature edits ---------------------------------------------------------


def append_bias(points: PointSet, name: str | None = None) -> PointSet:
    """B1: add a constant-1 feature as the last one."""
    name = name or f"x{points.d + 1}"
    if points.vector:
        df = points.df.withColumn(points.vector, F.concat(points.vector, F.array(F.lit(1.0))))
    else:
        df = points.df.withColumn(name, F.lit(1.0))
    return replace(points, df=df, features=points.features + (name,))


def slice_features(points: PointSet, k: int) -> PointSet:
    """B2: keep the first k features."""
    keep = points.features[:k]
    own = [F.slice(points.vector, 1, k).alias(points.vector)] if points.vector else list(keep)
    df = points.df.select(*([points.id] if points.id else []), *own, points.label)
    return replace(points, df=df, features=keep)


# --- A4 / A5: response and split -----------------------------------------------------


def respond_by_weights(points: PointSet, weights: Sequence[float], noise: Column, noise_scale: float) -> PointSet:
    """A4: replace the label by X.w + scale*noise for a given weight vector."""
    if len(weights) != points.d:
        raise ValueError("one weight per feature is required")
    z = vector_margin(weights, points.vector) if points.vector else linear_margin(weights, points.features)
    y = z + F.lit(float(noise_scale)) * noise
    return replace(points, df=points.df.withColumn(points.label, y), n_classes=None)


def held_out_split(points: PointSet, folds: int = 5, test_fold: int = 0) -> DataFrame:
    """A5: tag every row 'test' or 'train' by a deterministic fold of its id.

    All rows are kept; callers filter on the ``split`` column.
    """
    if points.id is None:
        raise ValueError("a deterministic split needs a row id")
    fold = F.pmod(F.col(points.id), F.lit(folds))
    return points.df.withColumn("split", F.when(fold == test_fold, "test").otherwise("train"))

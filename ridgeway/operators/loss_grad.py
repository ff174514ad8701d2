"""Loss and gradient aggregates over a point table.

Two strategies give the same sums:

* ``column``: margins, pointwise loss and ``dloss_c * x_j`` are Column
  expressions; one global aggregate (partial per task, final on one
  partition) returns ``n``, the loss sum and all C*d gradient sums. Nothing
  leaves the JVM. Used by one-shot queries, by fits with small C*d and by
  small model batches (line-search candidates, short λ lists); in a fit the
  weight-independent Columns are built once and only the margins change. A
  loss that has no NumPy form stays here at any width, in several aggregates.
* ``arrow``: ``mapInArrow`` computes ``X @ W.T`` and ``D.T @ X`` per Arrow
  batch with NumPy and emits one packed vector per task, summed in a tree.
  Used when the sums outgrow codegen: wide C*d, large model stacks (loss
  grids, SVM histories), vector points and batch losses.

Either way, the only data that reaches the driver is parameter-sized.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.losses import WRITTEN_OUT, Loss, get_loss, sql_double, vector_margin, weights_array
from ..sources.points import PointSet
from .tree_sum import PACKED, collect_sum, packed, tree_sum

# Sums that one Column aggregate holds within whole-stage codegen. Where a loss has
# both forms, wider work goes through Arrow; where it has Columns only, it is split.
COLUMN_FORM_MAX_OUTPUTS = 96


def as_matrix(W, n_margins: int, d: int) -> np.ndarray:
    """Weights as a (C, d) float matrix (a vector is one row)."""
    M = np.asarray(W, dtype=float)
    if M.ndim == 1:
        M = M.reshape(1, -1)
    if M.shape != (n_margins, d):
        raise ValueError(f"weights of shape {M.shape}, expected {(n_margins, d)}")
    return M


def _margin_count(points: PointSet, loss: Loss) -> int:
    return loss.n_margins(points.n_classes)


def margin_expr(weights, features) -> "F.Column":
    """x·w as one parsed expression (same left-to-right sum as ``linear_margin``).

    One call instead of 3·d Column calls: the cheap way to rebuild a margin on
    every step of a fit.
    """
    if len(features) > WRITTEN_OUT:
        names = ", ".join(f"`{x}`" for x in features)
        return F.expr(f"aggregate(zip_with(array({names}), {weights_array(weights)}, (x, w) -> w * x), 0D, (s, t) -> s + t)")
    terms = [f"({sql_double(w)} * `{x}`)" for w, x in zip(weights, features)]
    acc = terms[0]
    for t in terms[1:]:
        acc = f"({acc} + {t})"
    return F.expr(acc)


def point_margin(points: PointSet, weights) -> "F.Column":
    """B6 for a point table of either form: over its columns, or over its vector column."""
    if len(weights) != points.d:
        raise ValueError("one weight per feature is required")
    return vector_margin(weights, points.vector) if points.vector else margin_expr(weights, list(points.features))


class _StepPlan:
    """The weight-independent part of the Column aggregate for M models, built once.

    Only the margins change from step to step; the pointwise loss, its
    derivatives and the sums are reused. Output columns: ``n``, ``loss_{m}``,
    ``g_{m}_{c}_{j}``. ``slots`` limits the gradient sums to some (c, j).
    """

    def __init__(self, points: PointSet, loss: Loss, C: int, M: int = 1, with_grad: bool = True, slots=None):
        feats = list(points.features)
        self.feats, self.C, self.M = feats, C, M
        self.label = F.col(points.label).alias("_y")
        self.pw = [F.col(x) for x in feats]
        self.aggs = [F.count(F.lit(1)).alias("n")]
        slots = [(c, j) for c in range(C) for j in range(len(feats))] if slots is None else slots
        for m in range(M):
            lcol, dcols = loss.pointwise([F.col(f"_z{m}_{c}") for c in range(C)], F.col("_y"))
            self.pw.append(lcol.alias(f"_l{m}"))
            self.aggs.append(F.sum(f"_l{m}").alias(f"loss_{m}"))
            if with_grad:
                self.pw += [d.alias(f"_d{m}_{c}") for c, d in enumerate(dcols)]
                self.aggs += [
                    F.sum(F.col(f"_d{m}_{c}") * F.col(feats[j])).alias(f"g_{m}_{c}_{j + 1}") for c, j in slots
                ]

    def row(self, df: DataFrame, Ws: np.ndarray) -> DataFrame:
        Ws = np.asarray(Ws).reshape(self.M, self.C, len(self.feats))
        z = [margin_expr(Ws[m, c], self.feats).alias(f"_z{m}_{c}") for m in range(self.M) for c in range(self.C)]
        return df.select(*self.feats, self.label, *z).select(*self.pw).agg(*self.aggs)


def loss_grad_row(points: PointSet, loss: str | Loss, W, with_grad: bool = True) -> DataFrame:
    """One-row aggregate: ``n``, ``loss`` (sum) and ``g_{c}_{j}`` (sums), Column form."""
    loss = get_loss(loss)
    C = _margin_count(points, loss)
    row = _StepPlan(points, loss, C, 1, with_grad).row(points.df, as_matrix(W, C, points.d)[None])
    return row.toDF(*(c.replace("g_0_", "g_", 1) if c.startswith("g_0_") else "loss" if c == "loss_0" else c for c in row.columns))


def loss_grad_row_many(points: PointSet, loss: str | Loss, Ws, with_grad: bool = True) -> DataFrame:
    """One-row aggregate for M models at once: ``n``, ``loss_{m}``, ``g_{m}_{c}_{j}`` (Column form)."""
    loss = get_loss(loss)
    C = _margin_count(points, loss)
    Ws = np.asarray(Ws, dtype=float).reshape(-1, C, points.d)
    return _StepPlan(points, loss, C, len(Ws), with_grad).row(points.df, Ws)


def loss_grad_long(
    points: PointSet, loss: str | Loss, W, reduce: str = "mean", penalty=None, lam: float = 0.0
) -> DataFrame:
    """C2/C3/C4 result in long form: ``n, loss, class_id, feature_id, grad``.

    ``reduce='mean'`` divides by n (C2), ``'sum'`` keeps sums (C3). With a
    penalty, ``lam * score(W)`` and ``lam * grad(W)`` are added after the
    mean (C4); W is parameter-sized, so the penalty terms are literals.
    """
    loss = get_loss(loss)
    C = _margin_count(points, loss)
    Wm = as_matrix(W, C, points.d)
    if points.vector or C * points.d > COLUMN_FORM_MAX_OUTPUTS and loss.has_numpy:
        return _loss_grad_long_arrow(points, loss, Wm, reduce, penalty, lam)
    row = loss_grad_row(points, loss, Wm)
    scale = (1.0 / F.col("n")) if reduce == "mean" else F.lit(1.0)
    pen_score = 0.0
    pen_grad = np.zeros_like(Wm)
    if penalty is not None and lam:
        pen_score = lam * penalty.score(Wm if C > 1 else Wm[0])
        pen_grad = lam * np.asarray(penalty.grad(Wm if C > 1 else Wm[0])).reshape(Wm.shape)
    entries = [
        F.struct(
            F.lit(c).cast("int").alias("class_id"),
            F.lit(j + 1).cast("int").alias("feature_id"),
            (F.col(f"g_{c}_{j + 1}") * scale + F.lit(float(pen_grad[c, j]))).alias("grad"),
        )
        for c in range(C)
        for j in range(points.d)
    ]
    return row.select(
        F.col("n"),
        (F.col("loss") * scale + F.lit(float(pen_score))).alias("loss"),
        F.explode(F.array(*entries)).alias("e"),
    ).select("n", "loss", "e.class_id", "e.feature_id", "e.grad")


def _loss_grad_long_arrow(points, loss, Wm, reduce, penalty, lam) -> DataFrame:
    """Wide C*d: packed partials summed in a tree, laid out in the long form by the task that holds the sum."""
    C, d = Wm.shape
    pen_score = 0.0
    pen_grad = np.zeros_like(Wm)
    if penalty is not None and lam:
        pen_score = lam * penalty.score(Wm if C > 1 else Wm[0])
        pen_grad = lam * np.asarray(penalty.grad(Wm if C > 1 else Wm[0])).reshape(Wm.shape)

    def lay_out(batches):
        import pyarrow as pa

        for b in batches:
            for v in b.column("v"):
                v = np.frombuffer(v.as_py(), "<f8")
                scale = 1.0 / v[0] if reduce == "mean" else 1.0
                cols = [
                    np.full(C * d, int(v[0])), np.full(C * d, v[1] * scale + pen_score),
                    np.repeat(np.arange(C, dtype=np.int32), d), np.tile(np.arange(1, d + 1, dtype=np.int32), C),
                    v[2:] * scale + pen_grad.reshape(-1),
                ]
                names = ["n", "loss", "class_id", "feature_id", "grad"]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=names)

    total = tree_sum(_models_parts(points, loss, Wm[None], with_grad=True))
    return total.mapInArrow(lay_out, "n long, loss double, class_id int, feature_id int, grad double")


def point_count(points: PointSet) -> DataFrame:
    """N as a one-row aggregate (fused into C2/C3 elsewhere)."""
    return points.df.agg(F.count(F.lit(1)).alias("n"))


def pointwise_frame(points: PointSet, loss: str | Loss, W, keep: Sequence[str] = ()) -> DataFrame:
    """B7-B10 per row: margin(s), loss and gradient, for any width.

    The gradient is in columns ``g_{c}_{j}``; of vector points in one array
    column ``g_{c}`` per margin.
    """
    loss = get_loss(loss)
    C = _margin_count(points, loss)
    Wm = as_matrix(W, C, points.d)
    z = [point_margin(points, Wm[c]).alias(f"margin_{c}") for c in range(C)]
    base = points.df.select(*keep, *points.feature_columns(), F.col(points.label).alias("label"), *z)
    lcol, dcols = loss.pointwise([F.col(f"margin_{c}") for c in range(C)], F.col("label"))
    head = [*keep, "label", *[f"margin_{c}" for c in range(C)], lcol.alias("loss")]
    if points.vector:
        x = F.col(points.vector)
        # the derivative is an argument of zip_with, not part of its function, which would work it out for every element
        grads = [F.zip_with(x, F.array_repeat(d, points.d), lambda v, g: g * v).alias(f"g_{c}") for c, d in enumerate(dcols)]
        return base.select(*head, *grads)
    feats = list(points.features)
    grads = [(dcols[c] * F.col(x)).alias(f"g_{c}_{j + 1}") for c in range(C) for j, x in enumerate(feats)]
    return base.select(*head, *grads)


# --- Arrow partials -------------------------------------------------------------------


def batch_matrix(b, points_columns: Sequence[str], vector: str | None, d: int) -> np.ndarray:
    """The features of one Arrow batch as a (rows, d) matrix, from d columns or from one array column."""
    if vector:
        return np.asarray(b.column(vector).flatten().to_numpy(zero_copy_only=False), dtype=float).reshape(-1, d)
    return np.column_stack([b.column(f).to_numpy(zero_copy_only=False).astype(float, copy=False) for f in points_columns])


def _batches_of(points: PointSet):
    """A function that reads (X, y) from an Arrow batch of points."""
    feats, label, vector, d = list(points.features), points.label, points.vector, points.d

    def read(b):
        if b.num_rows:
            yield batch_matrix(b, feats, vector, d), b.column(label).to_numpy(zero_copy_only=False).astype(float, copy=False)

    return read


def _arrow_partials(read, loss: Loss, Ws: np.ndarray, with_grad: bool):
    """Per-task sums for M models as one packed vector: per model n, loss sum and gradient sums (C*d)."""
    M, C, d = Ws.shape
    flat = Ws.reshape(M * C, d)
    batch_fn = getattr(loss, "batch_fn", None)

    def fn(batches):
        n_acc = 0.0
        loss_acc = np.zeros(M)
        grad_acc = np.zeros((M, C, d)) if with_grad else None
        for X, y in (pair for b in batches for pair in read(b)):
            n_acc += X.shape[0]
            if batch_fn is not None:
                for m in range(M):
                    lsum, gsum = batch_fn(X, y, Ws[m])
                    loss_acc[m] += float(lsum)
                    if with_grad:
                        grad_acc[m] += np.asarray(gsum, dtype=float).reshape(C, d)
                continue
            if C == 1 and M > 1:
                rows = max(64, BLOCK_MARGINS // M)  # margins of one block stay in the processor's cache
                for at in range(0, len(y), rows):
                    x, t = X[at : at + rows], y[at : at + rows]
                    Z = x @ flat.T
                    if not with_grad:
                        loss_acc += loss.numpy_many_sums(Z, t)
                        continue
                    L, D = loss.numpy_many(Z, t)  # all models in one vectorised call
                    loss_acc += L.sum(axis=0)
                    grad_acc[:, 0, :] += D.T @ x
                continue
            Z = X @ flat.T
            for m in range(M):
                lm, D = loss.numpy(Z[:, m * C : (m + 1) * C], y)
                loss_acc[m] += lm.sum()
                if with_grad:
                    grad_acc[m] += D.T @ X
        if n_acc == 0:
            return
        vals = np.empty((M, 2 + (C * d if with_grad else 0)))
        vals[:, 0] = n_acc
        vals[:, 1] = loss_acc
        if with_grad:
            vals[:, 2:] = grad_acc.reshape(M, C * d)
        yield packed(vals.reshape(-1))

    return fn


BLOCK_MARGINS = 100_000
# Bounds of one job's model stack: sums in a task's packed vector, and margins of a row.
MAX_SUMS_PER_JOB = 2_000_000
MAX_MARGINS_PER_ROW = 1_000


def _stack(points: PointSet, loss: Loss, Ws) -> np.ndarray:
    C = _margin_count(points, loss)
    Ws = np.asarray(Ws, dtype=float)
    if Ws.ndim == 2:
        Ws = Ws[:, None, :] if C == 1 else Ws[None]
    if Ws.shape[1:] != (C, points.d):
        raise ValueError(f"model stack of shape {Ws.shape}, expected (M, {C}, {points.d})")
    return Ws


def _chunks(Ws: np.ndarray, with_grad: bool):
    """(first model, models) of stacks that one job takes; a single model always is one."""
    M, C, d = Ws.shape
    size = max(1, min(MAX_SUMS_PER_JOB // (2 + (C * d if with_grad else 0)), MAX_MARGINS_PER_ROW // C))
    for start in range(0, M, size):
        yield start, Ws[start : start + size]


def _models_parts(points: PointSet, loss: str | Loss, Ws, with_grad: bool) -> DataFrame:
    """One packed vector per task for one chunk of models, which travels in the task closure."""
    loss = get_loss(loss)
    fn = _arrow_partials(_batches_of(points), loss, _stack(points, loss, Ws), with_grad)
    return points.df.select(*points.feature_columns(), points.label).mapInArrow(fn, PACKED)


def models_frame(points: PointSet, loss: str | Loss, Ws) -> DataFrame:
    """Loss sums for a model stack as a DataFrame ``(model, n, loss_sum)``, no driver round trip."""
    loss = get_loss(loss)
    out = None
    for start, chunk in _chunks(_stack(points, loss, Ws), False):

        def lay_out(batches, start=start, M=len(chunk)):
            import pyarrow as pa

            for b in batches:
                for v in b.column("v"):
                    v = np.frombuffer(v.as_py(), "<f8").reshape(M, 2)
                    cols = [np.arange(start, start + M, dtype=np.int32), v[:, 0].astype(np.int64), np.ascontiguousarray(v[:, 1])]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["model", "n", "loss_sum"])

        part = tree_sum(_models_parts(points, loss, chunk, with_grad=False))
        part = part.mapInArrow(lay_out, "model int, n long, loss_sum double")
        out = part if out is None else out.unionByName(part)
    return out


def collect_models(points: PointSet, loss: str | Loss, Ws, with_grad: bool = True, blocks=None):
    """(n, loss_sums[M], grad_sums[M, C, d]) for a model stack, evaluated in chunks; over cached ``blocks`` where given."""
    loss = get_loss(loss)
    Ws = _stack(points, loss, Ws)
    M, C, d = Ws.shape
    losses = np.zeros(M)
    grads = np.zeros((M, C, d))
    n = 0.0
    for start, chunk in _chunks(Ws, with_grad):
        width = 2 + (C * d if with_grad else 0)
        if blocks is None:
            v = collect_sum(_models_parts(points, loss, chunk, with_grad), len(chunk) * width)
        else:
            v = blocks.collect(_arrow_partials(blocks.matrices(), loss, chunk, with_grad), len(chunk) * width)
        v = v.reshape(len(chunk), width)
        n = float(v[0, 0])
        losses[start : start + len(chunk)] = v[:, 1]
        if with_grad:
            grads[start : start + len(chunk)] = v[:, 2:].reshape(len(chunk), C, d)
    return n, losses, grads


# --- Evaluators used by the trainers --------------------------------------------------


class Evaluator:
    """Sums of loss and gradient at given weights: ``evaluate(W) -> (n, loss, G)``."""

    n_margins: int
    d: int

    def evaluate(self, W) -> tuple[float, float, np.ndarray]:
        raise NotImplementedError

    def evaluate_many(self, Ws, with_grad: bool = True) -> tuple[float, np.ndarray, np.ndarray]:
        out = [self.evaluate(W) for W in Ws]
        n = out[0][0] if out else 0.0
        return n, np.array([o[1] for o in out]), np.array([o[2] for o in out])

    def close(self) -> None:
        pass

    def __enter__(self):
        return self

    def __exit__(self, *exc) -> None:
        self.close()


class SparkEvaluator(Evaluator):
    """Evaluates on a (persisted) point table; one Spark job per call, or one per part of a wide Column form.

    ``strategy='auto'`` packs the points of a fit into cached blocks, over which
    a step is matrix products with the weights in the closure: no step plans or
    compiles anything for new weights. Losses without a NumPy form and batch
    losses with a Column form use the Column aggregate, and so do single evaluations (``persist=False``) while
    C*d stays small. The points stay in the partitions they come in. An empty
    table is an error.
    """

    def __init__(self, points: PointSet, loss: str | Loss, strategy: str = "auto", persist: bool = True):
        self.loss = get_loss(loss)
        self.n_margins = self.loss.n_margins(points.n_classes)
        self.d = points.d
        if strategy == "auto":
            narrow = self.n_margins * self.d <= COLUMN_FORM_MAX_OUTPUTS and not points.vector
            strategy = "column" if self.loss.has_columns and (narrow or not self.loss.has_numpy) else "arrow"
            if persist and self.loss.has_numpy and not (hasattr(self.loss, "batch_fn") and strategy == "column"):
                strategy = "blocks"
        if strategy == "column" and points.vector:
            points = points.wide()
        self.strategy = strategy
        self.blocks = None
        if strategy == "blocks":
            from .blocks import PointBlocks

            self.blocks, persist = PointBlocks(points), False
        self.points = points.persist() if persist else points.projected()
        self._owned = persist
        self.jobs = 0
        self._plans: dict[tuple, _StepPlan] = {}

    def _batch_columns_row(self, Ws: np.ndarray):
        """One aggregate over the Column form of a batch loss for M weight matrices."""
        feats = [F.col(x) for x in self.points.features]
        y = F.col(self.points.label)
        aggs = [F.count(F.lit(1)).alias("n")]
        for m, Wm in enumerate(Ws):
            lcol, gcols = self.loss.column_fn(Wm, feats, y)
            aggs.append(F.sum(lcol).alias(f"loss_{m}"))
            aggs += [F.sum(g).alias(f"g_{m}_{k}") for k, g in enumerate(gcols)]
        self.jobs += 1
        r = self.points.df.agg(*aggs).collect()[0]
        M = len(Ws)
        G = np.array([[r[f"g_{m}_{k}"] or 0.0 for k in range(self.n_margins * self.d)] for m in range(M)], dtype=float)
        losses = np.array([r[f"loss_{m}"] or 0.0 for m in range(M)], dtype=float)
        return float(r["n"]), losses, G.reshape(M, self.n_margins, self.d)

    def _columns_row(self, Ws: np.ndarray, with_grad: bool, slots=None):
        """One aggregate for M models; ``slots``: the only (c, j) whose gradient sums it takes."""
        M, C, d = Ws.shape
        key = (M, with_grad, None if slots is None else tuple(slots))
        if key not in self._plans:
            self._plans[key] = _StepPlan(self.points, self.loss, C, M, with_grad, slots)
        self.jobs += 1
        r = self._plans[key].row(self.points.df, Ws).collect()[0]
        losses = np.array([r[f"loss_{m}"] or 0.0 for m in range(M)], dtype=float)
        grads = np.zeros((M, C, d))
        if with_grad:
            for m in range(M):
                for c, j in slots if slots is not None else [(c, j) for c in range(C) for j in range(d)]:
                    grads[m, c, j] = r[f"g_{m}_{c}_{j + 1}"] or 0.0
        return float(r["n"]), losses, grads

    def _column_parts(self, Ws: np.ndarray, with_grad: bool):
        """The Column form in as many aggregates as its sums need."""
        M, C, d = Ws.shape
        width = 1 + (C * d if with_grad else 0)
        batch = hasattr(self.loss, "batch_fn")
        if batch or width <= COLUMN_FORM_MAX_OUTPUTS:
            size = max(1, COLUMN_FORM_MAX_OUTPUTS // width)
            parts = [Ws[i : i + size] for i in range(0, M, size)]
            done = [self._batch_columns_row(p) if batch else self._columns_row(p, with_grad) for p in parts]
            return done[0][0], np.concatenate([p[1] for p in done]), np.concatenate([p[2] for p in done])
        slots = [(c, j) for c in range(C) for j in range(d)]
        n, losses, grads = 0.0, np.zeros(M), np.zeros((M, C, d))
        for m in range(M):
            for i in range(0, len(slots), COLUMN_FORM_MAX_OUTPUTS):
                n, l, g = self._columns_row(Ws[m : m + 1], True, slots[i : i + COLUMN_FORM_MAX_OUTPUTS])
                losses[m] = l[0]
                grads[m] += g[0]
        return n, losses, grads

    def evaluate(self, W):
        n, losses, grads = self.evaluate_many(as_matrix(W, self.n_margins, self.d)[None])
        return n, float(losses[0]), grads[0]

    def evaluate_many(self, Ws, with_grad=True):
        Ws = np.asarray(Ws, dtype=float).reshape(-1, self.n_margins, self.d)
        M, C, d = Ws.shape
        fits = M * (1 + (C * d if with_grad else 0)) <= COLUMN_FORM_MAX_OUTPUTS
        if self.strategy == "column" and (fits or not self.loss.has_numpy):
            n, losses, grads = self._column_parts(Ws, with_grad)
        else:
            self.jobs += len(list(_chunks(Ws, with_grad)))
            n, losses, grads = collect_models(self.points, self.loss, Ws, with_grad, self.blocks)
        if n == 0:
            raise ValueError("empty point table")
        return n, losses, grads

    def close(self):
        if self.blocks is not None:
            self.blocks.close()
        if self._owned:
            self.points.unpersist()

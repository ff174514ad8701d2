"""Linear SVM through its box-constrained dual.

The modelled library collects the data to the driver and rebuilds the n×n
signed kernel K_ij = y_i y_j x_i·x_j on every step. Here nothing is collected
and no pair table is formed: with v = Σ_i a_i y_i x_i,

    (K a)_i = y_i x_i · v,   D(a) = −‖v‖²/(4λ) + Σ a_i,
    ∇(−D)_i = y_i (x_i · v)/(2λ) − 1,

so a projected-gradient step needs of the data only v, Σa and ‖Δa‖².

A job takes a window of steps. Between the few steps at which some multiplier
reaches or leaves its bound, v follows a linear recursion with the Gram matrix of
the rows inside the box, so the driver can guess the coming v. Each task takes
its rows through the window with the guesses and returns Σ a_i y_i x_i after
every step. Guesses that come back as they went out are the true steps, and so is
the first sum that doesn't: at least one step of a window counts, mostly many.
The others are corrected by the same recursion, with the Gram matrices that the
rows inside the box had in spans of the window, and go into the next window. The
rows that cross a bound in the window or would soon do so, a bounded number of
them and at most a quarter of all, reach the driver as they are and are stepped
there one by one, so that mostly the whole next window is guessed right.

The points are packed once into blocks of rows (a matrix y_i x_i per block),
written, and cached by block. The multipliers are a narrow table (block, a). A
window joins the two without moving the points, replays the steps since the
table was last written, and returns one packed vector per task. Every
``checkpoint_every`` steps, or as many as a window has if that is more, the
multipliers alone are written to the shared checkpoint folder and the superseded
table is deleted, so a lost executor replays few steps.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.losses import _check_pm1
from ..session import drop_path, scratch_path, stored
from ..sources.points import PointSet
from .blocks import PointBlocks
from .loss_grad import batch_matrix, collect_models, point_margin
from .tree_sum import PACKED, collect_sum, packed


def signed_kernel_product(points: PointSet, a: str = "a") -> DataFrame:
    """C6 re-aimed: (K a)_i = y_i x_i · Σ_j a_j y_j x_j for every row, in O(n d).

    Returns the point rows with ``ka``. The all-pairs kernel table itself is
    never built.
    """
    v = _dual_sums(points, a)[1:]
    return points.df.withColumn("ka", F.col(points.label) * point_margin(points, v))


def _dual_sums(points: PointSet, a: str = "a") -> np.ndarray:
    """Σ a and Σ a_i y_i x_i in one scan, summed in a tree."""
    d, feats, label, vector = points.d, list(points.features), points.label, points.vector

    def run(batches):
        total, seen = np.zeros(d + 2), False
        for b in batches:
            if b.num_rows == 0:
                continue
            seen = True
            y = b.column(label).to_numpy(zero_copy_only=False).astype(float, copy=False)
            _check_pm1(y)
            m = b.column(a).to_numpy(zero_copy_only=False).astype(float, copy=False)
            total += np.r_[len(y), m.sum(), (m * y) @ batch_matrix(b, feats, vector, d)]
        if seen:
            yield packed(total)

    total = collect_sum(points.df.select(*points.feature_columns(), label, a).mapInArrow(run, PACKED), d + 2)
    if not total[0]:
        raise ValueError("empty point table")
    return total[1:]


def dual_gradient_column(points: PointSet, v, lam: float) -> Column:
    """∇(−D)_i = y_i (x_i · v)/(2λ) − 1 with v given (parameter-sized)."""
    return (F.col(points.label) * point_margin(points, v)) / F.lit(2.0 * lam) - 1.0


def dual_objective_grad(points: PointSet, lam: float, a: str = "a") -> DataFrame:
    """Per row ``id, a, grad`` and the dual objective D(a) (repeated); one job besides the rows'."""
    total, *v = _dual_sums(points, a)
    obj = -float(np.dot(v, v)) / (4.0 * lam) + float(total)
    return points.df.select(
        points.id, F.col(a).alias("a"), dual_gradient_column(points, v, lam).alias("grad"), F.lit(obj).alias("objective")
    )


@dataclass
class SVMFit:
    lam: float
    multipliers: DataFrame  # (id, a), checkpointed state
    weights: np.ndarray
    dual_hist: list[float]
    weight_path: list[np.ndarray]
    eta_hist: list[float]
    norm_hist: list[float | None] = field(default_factory=list)
    status: str = "max_iter"
    jobs: int = 0

    def model_frame(self, spark: SparkSession) -> DataFrame:
        rows = [(0, 0, j + 1, float(w)) for j, w in enumerate(self.weights)]
        return spark.createDataFrame(rows, "model_id int, class_id int, feature_id int, weight double")

    def trace_frame(self, spark: SparkSession, run_id: str) -> DataFrame:
        """A6 for the dual: one row per iterate with D(a_t), η_t, ‖a_{t+1} − a_t‖ and w_t."""
        rows = []
        for t, (dual, w) in enumerate(zip(self.dual_hist, self.weight_path)):
            eta = self.eta_hist[t] if t < len(self.eta_hist) else None
            norm = self.norm_hist[t] if t < len(self.norm_hist) else None
            rows.append((run_id, t, float(dual), eta, norm, "current", [float(v) for v in w]))
        return spark.createDataFrame(
            rows, "run_id string, iter int, loss double, eta double, norm double, eval_point string, "
                  "weights array<double>")


def svm_lipschitz_constant(points: PointSet, lam: float) -> float:
    """C8 for the dual: λmax(K)/(2λ) with K = D X Xᵀ D (D = diag(y), y² = 1).

    The nonzero eigenvalues of X Xᵀ are those of XᵀX, so one moments scan
    (d×d on the driver), or Lanczos steps over the points where that matrix
    would be too large, replace the n×n kernel.
    """
    from .moments import largest_eigenvalue

    return largest_eigenvalue(points, "sum") / (2.0 * lam)


BLOCK_ROWS = 4096


def _point_blocks(points: PointSet) -> DataFrame:
    """(block, ids, yx): rows packed into matrices y_i x_i of at most ``BLOCK_ROWS`` rows, kept together by block."""
    feats, label, vector, d, id_name = list(points.features), points.label, points.vector, points.d, points.id

    def pack(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        block = TaskContext.get().partitionId() << 40
        for b in batches:
            if b.num_rows == 0:
                continue
            y = b.column(label).to_numpy(zero_copy_only=False).astype(float, copy=False)
            _check_pm1(y)
            yx = batch_matrix(b, feats, vector, d) * y[:, None]
            ids = b.column(id_name).to_numpy(zero_copy_only=False).astype("<i8")
            rows = []
            for at in range(0, len(y), BLOCK_ROWS):
                rows.append((block, ids[at : at + BLOCK_ROWS].tobytes(), yx[at : at + BLOCK_ROWS].astype("<f8").tobytes()))
                block += 1
            types = (pa.int64(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=["block", "ids", "yx"])

    src = points.df.select(points.id, *points.feature_columns(), label)
    return src.mapInArrow(pack, "block long, ids binary, yx binary")


def _dealt(frame: DataFrame, parts: int) -> DataFrame:
    """Cached by block in ``parts`` partitions: two such frames join without an exchange or a sort."""
    return frame.repartition(parts, "block").sortWithinPartitions("block").persist(StorageLevel.MEMORY_AND_DISK)


WINDOW_NUMBERS, SHORTEST_WINDOW = 1 << 17, 64  # numbers of the guesses that a job takes ahead, at most; steps, at least
STEP_NUMBERS = 1 << 21  # steps times rows that a task holds at once
GRAM_NUMBERS, SPANS = 1 << 18, 64  # numbers of a window's Gram matrices, and spans of steps that have one
NEAR_NUMBERS, NEAR_SHARE = 1 << 17, 0.25  # numbers, and share of all rows, that go to the driver as single rows, at most
SAME = 1e-12  # guesses count as right within this share of the largest number; the order of summing moves them as much


def _longest_window(d: int) -> int:
    return min(2048, max(512, WINDOW_NUMBERS // d))


def _replayed(yx, a, steps, lam):
    """Multipliers after the given (v, η) steps from a."""
    ahead = min(len(steps), max(1, STEP_NUMBERS // max(1, len(a))))
    for at in range(0, len(steps), max(1, ahead)):
        part = steps[at : at + ahead]
        Z = np.array([v for v, _ in part]) @ yx.T
        for z, (_, eta) in zip(Z, part):
            a = np.clip(a - eta * (z / (2.0 * lam) - 1.0), 0.0, 1.0)
    return a


def _spans(K: int, d: int) -> np.ndarray:
    """Bounds of the spans of a window of K steps, none where even one Gram matrix is too large."""
    spans = min(SPANS, K, GRAM_NUMBERS // (d * d))
    return np.unique(np.linspace(0, K, spans + 1).astype(int)) if spans else np.zeros(1, int)


def _window_sums(yx, a, V, etas, lam, cuts, most) -> tuple[np.ndarray, np.ndarray]:
    """Of rows taken through steps with the given v: Σ a y x and Σ a before and after every step, ‖Δa‖² of each,
    and per span the sum of y x (y x)ᵀ over the rows, by the share of the span's steps that leave them inside the box;
    that sum and Σ y x over the rows that the last step leaves there.

    The ``most`` rows that cross a bound, or come next to it, aren't in the sums from the spans' on; they come back as (a, y x).
    """
    K, (rows, d) = len(V), yx.shape
    A, inside = np.empty((K + 1, rows)), V @ yx.T
    inside /= 2.0 * lam
    A[0] = a
    for k in range(K):
        step = inside[k]
        step -= 1.0
        step *= -etas[k]
        step += A[k]
        np.clip(step, 0.0, 1.0, out=A[k + 1])
    out, near = [(A @ yx).reshape(-1), A.sum(axis=1)], np.zeros(0, int)
    moves = np.diff(A, axis=0)
    out.append(np.einsum("ij,ij->i", moves, moves))
    if len(cuts) > 1:
        low, high = inside.min(axis=0), inside.max(axis=0)
        whole, some = (low > 0.0) & (high < 1.0), ~((low > 0.0) & (high < 1.0) | (high <= 0.0) | (low >= 1.0))
        # how far a row stays from a change of sides, negative if it changes, in windows at the pace of this one
        slack = np.maximum(np.minimum(low, 1.0 - high), np.maximum(-high, low - 1.0)) / (high - low)
        near = np.argsort(slack, kind="stable")[:most]
        whole[near] = some[near] = False
        free = inside[:, some]
        free = (free > 0.0) & (free < 1.0)
        share = np.add.reduceat(free, cuts[:-1], axis=0, dtype=float) / np.diff(cuts)[:, None]
        always, x, upper = yx[whole].T @ yx[whole], yx[some], np.triu_indices(d)
        out += [(always + (x * w[:, None]).T @ x)[upper] for w in (*share, free[-1])]
        out.append(yx[whole].sum(axis=0) + free[-1] @ x)
    return np.concatenate(out), np.column_stack([a[near], yx[near]])


def _next_guesses(V, etas, sums, grams, pull, cuts, near, right, lam, coming) -> np.ndarray:
    """The v of the coming steps: exact in the first row, the window's own guesses corrected, then the recursion carried on.

    ``grams``: one a span, and that of the rows inside the box at the end; ``pull``: Σ y x of these.
    ``near``: rows (a, y x) at the window's start that the Gram matrices leave out and that are stepped one by one.
    ``coming``: the step sizes from the first step of the window to the last one to guess.
    """
    K, d = V.shape
    yx, guesses = np.ascontiguousarray(near[:, 1:]), [sums[right]]
    with np.errstate(all="ignore"):
        A, Z = np.empty((K + 1, len(yx))), V @ yx.T
        A[0] = near[:, 0]
        for k in range(K):
            np.clip(A[k] - etas[k] * (Z[k] / (2.0 * lam) - 1.0), 0.0, 1.0, out=A[k + 1])
        own = A @ yx  # what these rows have in the sums
        span = np.searchsorted(cuts, np.arange(K), side="right") - 1
        v, a, change = sums[right], A[right], np.zeros(d)
        for k in range(right, len(coming) - 1):
            new = np.clip(a - coming[k] * (yx @ v / (2.0 * lam) - 1.0), 0.0, 1.0)
            if k < K:
                change = change - etas[k] / (2.0 * lam) * (grams[span[k]] @ (v - V[k]))
                v = sums[k + 1] + change + (new @ yx - own[k + 1])
            else:
                v = v + coming[k] * (pull - grams[-1] @ v / (2.0 * lam)) + (new - a) @ yx
            a = new
            guesses.append(v)
    guesses = np.array(guesses[: len(coming) - right])
    wrong = np.flatnonzero(~np.isfinite(guesses).all(axis=1))
    return guesses[: max(1, wrong[0])] if len(wrong) else guesses


def fit_svm_dual(
    points: PointSet,
    lam: float,
    lr: float | str = "lipschitz",
    lr_decay: bool = False,
    n_iter: int = 20000,
    tol: float = 1e-6,
    checkpoint_every: int = 25,
) -> SVMFit:
    """Projected gradient on the dual over a ∈ [0, 1]^n.

    ``lr='lipschitz'`` takes the step 1/L from one moments scan; a number sets
    it, with ``lr_decay`` as lr/√t. Labels must be ±1 and the table not empty.
    Stops when ‖Δa‖ < tol or after n_iter steps. The result's multipliers are a
    table (id, a) in the checkpoint folder. A job takes many steps (see above), but
    only one of points so wide that a Gram matrix doesn't go with each task's sums.
    """
    if points.id is None:
        raise ValueError("the dual needs a row id for its multipliers")
    if n_iter <= 0 or tol < 1e-6 or (lr != "lipschitz" and lr <= 0):
        raise ValueError("n_iter > 0, tol >= 1e-6 and lr > 0 are required")
    spark, d = points.df.sparkSession, points.d
    blocks_path = scratch_path(spark, "blocks")
    source = _point_blocks(points)
    source.write.parquet(blocks_path)
    packed_points = spark.read.schema(source.schema).parquet(blocks_path)
    size = packed_points.agg(F.sum(F.length("yx"))).first()[0] or 0
    parts = max(1, -(-size // min(PARTITION_BYTES, max(WINDOW_BYTES, size // WINDOW_TASKS))))
    blocks = _dealt(packed_points, parts)
    n_points = size // (8 * d)
    places = {p: i for i, (p,) in enumerate(sorted(blocks.select(F.spark_partition_id()).distinct().collect()))}  # of tasks that hold points
    tables: list[str] = []

    def write(frame: DataFrame, kind: str) -> DataFrame:
        tables.append(scratch_path(spark, kind))
        frame.write.parquet(tables[-1])
        return spark.read.schema(frame.schema).parquet(tables[-1])

    def with_state(state: DataFrame | None) -> DataFrame:
        if state is None:  # a_0 = 0
            return blocks.select("block", "ids", "yx", F.lit(None).cast("binary").alias("a"))
        return blocks.hint("merge").join(state, "block").select("block", "ids", "yx", "a")

    def replayed(batches, steps):
        """(block, ids, y x, multipliers after the steps) of every block."""
        for b in batches:
            for block, ids, yx, a in zip(*(b.column(i) for i in range(4))):
                yx = np.frombuffer(yx.as_buffer(), "<f8").reshape(-1, d)
                a = np.frombuffer(a.as_py(), "<f8") if a.is_valid else np.zeros(len(yx))
                yield block.as_py(), ids.as_py(), yx, _replayed(yx, a, steps, lam)

    def window(state, steps, V, etas):
        """Rows, the sums of ``_window_sums`` over all points, and the rows near a bound; small blocks are taken together."""
        cuts = _spans(len(V), d)
        held_rows = max(1, min(BLOCK_ROWS, STEP_NUMBERS // len(V)))
        slots = min(NEAR_NUMBERS // (d + 1), int(NEAR_SHARE * n_points)) // max(1, len(places)) if len(cuts) > 1 else 0
        grams = len(cuts) if len(cuts) > 1 else 0
        pull = d if grams else 0
        size = 1 + (len(V) + 1) * (d + 1) + len(V) + grams * (d * (d + 1) // 2) + pull
        width = size + len(places) * slots * (d + 1)  # every task has its own slots, zeros elsewhere

        def run(batches):
            from pyspark import TaskContext

            place = places.get(TaskContext.get().partitionId())
            total, held, rows, given = np.zeros(width), [], 0, 0

            def add():
                nonlocal rows, given
                many = [np.concatenate(m) for m in zip(*held)]
                held.clear()
                for at in range(0, len(many[1]), held_rows):
                    yx, a = (m[at : at + held_rows] for m in many)
                    rows += len(a)
                    most = 0 if place is None else min(slots, math.ceil(rows * slots * len(places) / n_points)) - given
                    with np.errstate(all="ignore"):
                        sums, near = _window_sums(yx, a, V, etas, lam, cuts, most)
                    total[1:size] += sums
                    if len(near):
                        start = size + (place * slots + given) * (d + 1)
                        total[start : start + near.size] = near.reshape(-1)
                        given += len(near)

            for _, _, yx, a in replayed(batches, steps):
                if held and sum(len(m[1]) for m in held) + len(a) > BLOCK_ROWS:
                    add()
                held.append((yx, a))
            if held:
                add()
                total[0] = rows
                yield packed(total)

        K, total = len(V), collect_sum(with_state(state).mapInArrow(run, PACKED), width, len(places))
        n, sums, sum_a, moved, upper, pull, near = np.split(total, np.cumsum([1, (K + 1) * d, K + 1, K, grams * (d * (d + 1) // 2), pull]))
        i, j = np.triu_indices(d)
        grams = np.zeros((grams, d, d))
        grams[:, i, j] = grams[:, j, i] = upper.reshape(len(grams), len(i))
        near = near.reshape(-1, d + 1)
        return n[0], sums.reshape(K + 1, d), sum_a, np.sqrt(moved), grams, pull, cuts, near[near[:, 1:].any(axis=1)]

    def as_state(state, steps):
        def run(batches):
            import pyarrow as pa

            for block, _, _, a in replayed(batches, steps):
                yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([a.tobytes()], pa.binary())], names=["block", "a"])

        return write(with_state(state).mapInArrow(run, "block long, a binary"), "multipliers")

    def as_rows(state, steps):
        def run(batches):
            import pyarrow as pa

            for _, ids, _, a in replayed(batches, steps):
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(ids, "<i8")), pa.array(a)], names=["id", "a"])

        return write(with_state(state).mapInArrow(run, "id long, a double"), "multipliers")

    start = np.zeros(d)
    dual_hist, path, etas, norms = [0.0], [start], [], []
    status, state, steps = "max_iter", None, []
    V, ahead = start[None], SHORTEST_WINDOW  # guesses from the step after the last one known; the first is no guess
    try:
        if lr == "lipschitz":
            lr = 1.0 / svm_lipschitz_constant(points, lam)

        def sizes(first, count):
            return np.array([lr / math.sqrt(t + 1) if lr_decay else lr for t in range(first, min(first + count, n_iter))])

        jobs = 1
        while status != "converged" and len(etas) < n_iter:
            K, t = len(V), len(etas)
            eta = sizes(t, K)
            n, sums, sum_a, moved, grams, pull, cuts, near = window(state, list(steps), V, eta)
            jobs += 1
            if n == 0:
                raise ValueError("empty point table")
            finite = np.abs(sums[:K][np.isfinite(sums[:K])])
            agree = np.isclose(sums[:K], V, rtol=0.0, atol=SAME * max(1.0, finite.max(initial=0.0)), equal_nan=True).all(axis=1)
            right = max(1, int(np.argmin(agree)) if not agree.all() else K)
            for k in range(right):
                v = sums[k + 1]
                steps.append((V[k], eta[k]))
                etas.append(float(eta[k]))
                dual_hist.append(-float(v @ v) / (4.0 * lam) + float(sum_a[k + 1]))
                path.append(v / (2.0 * lam))
                norms.append(float(moved[k]))
                if norms[-1] < tol:
                    status = "converged"
                    break
            if status == "converged" or len(etas) == n_iter:
                break
            ahead = min(2 * ahead, _longest_window(d)) if right == K else ahead if 3 * right >= K else max(ahead // 2, SHORTEST_WINDOW)
            V = sums[right][None] if len(cuts) < 2 else _next_guesses(V, eta, sums, grams, pull, cuts, near, right, lam, sizes(t, right + ahead))
            if len(steps) >= max(checkpoint_every, len(V)):
                new = as_state(state, list(steps))
                if state is not None:
                    state.unpersist()
                state = _dealt(new, parts)
                state.count()
                jobs += 2
                if len(tables) > 1:
                    drop_path(spark, tables.pop(-2))
                steps = []
        mult = as_rows(state, list(steps))
        if len(tables) > 1:
            drop_path(spark, tables.pop(-2))
    finally:
        blocks.unpersist()
        if state is not None:
            state.unpersist()
        drop_path(spark, blocks_path)
    return SVMFit(lam, mult, path[-1], dual_hist, path, etas, norms, status, jobs)


WINDOW_BYTES, WINDOW_TASKS = 4 << 20, 128  # a window is much work on few bytes: smaller partitions, but not too many sums


PARTITION_BYTES = 64 << 20


def fit_svm_ascent(
    points: PointSet,
    lam: float,
    gap_tol: float = 1e-6,
    max_rounds: int = 200,
    sweeps: int = 30,
    partition_bytes: int = PARTITION_BYTES,
) -> SVMFit:
    """E6 by dual coordinate ascent inside the partitions, their changes added up once a round.

    Every task sweeps its own rows, about ``partition_bytes`` of them, which it holds: coordinate i moves to the best of its box
    given v and σ' times the change its task has made so far, σ' being the
    number of partitions, so that adding all tasks' changes never lowers the
    dual objective. A round returns one d-vector per task and writes the narrow
    multiplier table (its predecessor is deleted), which is where a lost executor
    starts again. Rounds stop when the duality gap at their start is at most
    ``gap_tol`` times the primal objective (at least 1); ``dual_hist`` and
    ``norm_hist`` hold the dual objective and the gap of every round. The number of
    partitions follows from the bytes of the points. Rows of zeros have their
    multiplier at 1. All working tables but the multipliers are deleted at the end.
    """
    if points.id is None:
        raise ValueError("the dual needs a row id for its multipliers")
    if gap_tol <= 0 or max_rounds <= 0 or sweeps <= 0 or lam <= 0:
        raise ValueError("lam, gap_tol, max_rounds and sweeps must be positive")
    spark, d = points.df.sparkSession, points.d
    tables: list[str] = []

    def write(frame: DataFrame, kind: str) -> DataFrame:
        tables.append(scratch_path(spark, kind))
        frame.write.parquet(tables[-1])
        return spark.read.schema(frame.schema).parquet(tables[-1])

    packed_points = write(_point_blocks(points), "blocks")
    size = packed_points.agg(F.sum(F.length("yx"))).first()[0]
    if not size:
        drop_path(spark, tables.pop())
        raise ValueError("empty point table")
    parts = -(-size // partition_bytes)
    blocks = _dealt(packed_points, parts)
    state, v, sum_a, n, jobs = None, np.zeros(d), 0.0, None, 3
    dual_hist, gaps, path, status = [], [], [], "max_iter"

    def round_(batches, v, number):
        """Multipliers of every block after the task's sweeps; on its last row what the round adds to v, Σa, n and Σ hinge at v."""
        import pyarrow as pa
        from pyspark import TaskContext

        held, mats, states = [], [], []
        for b in batches:
            for block, ids, yx, a in zip(*(b.column(i).to_pylist() for i in range(4))):
                mats.append(np.frombuffer(yx, "<f8").reshape(-1, d))
                states.append(np.zeros(len(mats[-1])) if a is None else np.frombuffer(a, "<f8"))
                held.append((block, ids, len(mats[-1])))
        if not held:
            return
        yx, a = np.concatenate(mats), np.concatenate(states)
        del mats, states
        hinge = np.maximum(0.0, 1.0 - yx @ (v / (2.0 * lam))).sum()
        change = np.zeros(d) if number == max_rounds else _sweep(yx, a, v, float(parts), lam, sweeps, (number, TaskContext.get().partitionId()))
        cuts = np.cumsum([0, *(n for _, _, n in held)])
        rows = [(block, a[lo:hi].tobytes(), ids, None) for (block, ids, _), lo, hi in zip(held, cuts, cuts[1:])]
        rows[-1] = (*rows[-1][:3], np.r_[change, hinge, a.sum(), len(a)].astype("<f8").tobytes())
        types = [pa.int64(), pa.binary(), pa.binary(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=["block", "a", "ids", "told"])

    try:
        for t in range(max_rounds + 1):
            joined = blocks.select("block", "ids", "yx", F.lit(None).cast("binary").alias("a"))
            if state is not None:
                joined = blocks.hint("merge").join(state.select("block", "a").repartition(parts, "block"), "block")
            joined = joined.select("block", "ids", "yx", "a")
            new = write(
                joined.mapInArrow(lambda bs, v=v, t=t: round_(bs, v, t), "block long, a binary, ids binary, told binary"), "multipliers"
            )
            total = np.zeros(d + 3)
            for r in new.where("told IS NOT NULL").select("told").toLocalIterator():
                total += np.frombuffer(bytes(r.told), "<f8")
            jobs += 2
            n = int(total[d + 2])
            dual = -float(v @ v) / (4.0 * lam) + sum_a
            primal = float(total[d]) + float(v @ v) / (4.0 * lam)
            dual_hist.append(dual)
            gaps.append(primal - dual)
            path.append(v / (2.0 * lam))
            if gaps[-1] <= gap_tol * max(1.0, abs(primal)):
                status = "converged"
                drop_path(spark, tables.pop())
                break
            if t == max_rounds:
                drop_path(spark, tables.pop())
                break
            if state is not None:
                drop_path(spark, tables.pop(-2))
            state, v, sum_a = new, v + total[:d], float(total[d + 1])
        if state is None:  # the start was good enough: all multipliers are 0
            state = blocks.select("block", F.lit(None).cast("binary").alias("a"), "ids")

        def flat(batches):
            import pyarrow as pa

            for b in batches:
                for a, ids in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    ids = np.frombuffer(ids, "<i8")
                    yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(np.zeros(len(ids)) if a is None else np.frombuffer(a, "<f8"))], names=["id", "a"])

        multipliers = stored(state.select("a", "ids").mapInArrow(flat, "id long, a double"), "multipliers")
    finally:
        blocks.unpersist()
        for path_ in tables:
            drop_path(spark, path_)
    return SVMFit(lam, multipliers, path[-1], dual_hist, path, [], gaps, status, jobs)


def _sweep(yx, a, v, sigma, lam, sweeps, seed) -> np.ndarray:
    """Coordinate ascent over a task's rows in random order; moves ``a`` in place and returns the change of v.

    After each sweep over all rows the few whose multiplier lies inside the box
    are swept until they hardly move: they decide the model, the others stay put.
    """
    scale = sigma / (2.0 * lam)
    norms = scale * np.einsum("ij,ij->i", yx, yx)
    a[norms == 0] = 1.0  # such a row's multiplier has no effect on v
    before = a.copy()
    rows = np.flatnonzero(norms)
    u = v / (2.0 * lam)
    rng = np.random.default_rng(seed)

    def visit(order):
        most = 0.0
        for i in order:
            x, old = yx[i], a[i]
            new = min(1.0, max(0.0, old + (1.0 - x @ u) / norms[i]))
            if new != old:
                a[i] = new
                np.add(u, (scale * (new - old)) * x, out=u)
                most = max(most, abs(new - old))
        return most

    for _ in range(sweeps):
        most = visit(rng.permutation(rows))
        if most < 1e-9:
            break
        free = rows[(a[rows] > 0.0) & (a[rows] < 1.0)]
        # about as much work as the sweep over all rows
        for _ in range(min(100, 1 + len(rows) // max(1, len(free)))):
            if visit(rng.permutation(free)) < 1e-10:
                break
    return (a - before) @ yx


def dual_to_weights(multipliers: DataFrame, points: PointSet, lam: float) -> DataFrame:
    """w = (1/2λ) Σ a_i y_i x_i, joining multipliers (id, a) to the points by id.

    Every point must have exactly one multiplier: repeated or missing ids are an error.
    """
    mult = multipliers.select(F.col("id").alias("_id"), F.col("a").alias("_a"))
    joined = points.df.join(mult, F.col(points.id) == F.col("_id"))
    sizes = {points.df.count(), multipliers.count(), joined.count()}
    if len(sizes) > 1:
        raise ValueError("ids of points and multipliers don't match one to one")
    w = _dual_sums(points.with_df(joined), "_a")[1:] / (2.0 * lam)
    rows = [(0, 0, k + 1, float(x)) for k, x in enumerate(w)]
    return points.df.sparkSession.createDataFrame(rows, "model_id int, class_id int, feature_id int, weight double")


def primal_history(points: PointSet, fit: SVMFit) -> list[float]:
    """F8: Σ hinge(w_t) + λ‖w_t‖² for every iterate, one job over cached blocks per 1,000 iterates."""
    Ws = np.asarray(fit.weight_path)
    with PointBlocks(points) as blocks:
        _, losses, _ = collect_models(points, "hinge", Ws, with_grad=False, blocks=blocks)
    return [float(losses[t] + fit.lam * np.dot(Ws[t], Ws[t])) for t in range(len(Ws))]


def classify(points: PointSet, weights) -> DataFrame:
    """margin x·w and the class sign (≥ 0 → +1) per row of wide or vector points."""
    z = point_margin(points, weights)
    rows = points.df.select(F.col(points.id).alias("id"), z.alias("margin"))
    return rows.select("id", "margin", F.when(F.col("margin") >= 0, F.lit(1.0)).otherwise(F.lit(-1.0)).alias("prediction"))
